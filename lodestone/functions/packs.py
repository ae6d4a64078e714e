"""Fixed values of the shader-snippet rule pack, as plain text and in their natural order: results depend on them."""

# Literal marks of a snippet.
SNIPPET_MARKS = ["@P", "@N", "@Cd", "@ptnum", "@primnum", "ch(", "chf(", "chi(", "chv(", "point(", "prim(", "setpointattrib(", "pcopen(", "pcfind(", "nearpoints(", "vector ", "float ", "int "]

# Fence languages that never or possibly hold snippets, and the pattern that tells.
OTHER_LANGUAGES = ["python", "py", "bash", "sh", "shell", "json", "yaml", "hscript"]
OWN_LANGUAGES = ["vex", "vfl"]
LIKE_LANGUAGES = ["vex", "vfl", "c", "cpp", "c++", "hlsl", ""]
SNIPPET_PATTERN = r"@\w+|ch[fivs]?\(|point\(|prim\(|set\w+attrib\(|pcopen\(|pcfind\(|nearpoints?\(|addpoint\(|addprim\(|\bvector\b|\bfloat\b|\bint\b|\bforeach\b"

# Content types.
PATTERN_SIGNALS = [r"\bstep\s*\d+\b", r"\bfirst\b.*\bthen\b", r"\bhow\s+to\b", r"\brecipe\b", r"\bworkflow\b", r"\bsetup\b", r"\bpattern\b", r"\btechnique\b", r"\btrick\b"]
REFERENCE_SIGNALS = [r"\bsignature\b", r"\breturn(?:s|ed)?\s+(?:type|value)\b", r"\bparameter(?:s)?\b.*\btype\b", r"\bsyntax\b", r"^\w+\s*\(.*\)\s*$"]
TROUBLE_SIGNALS = [
    r"\berror\b", r"\bfix(?:ed|ing)?\b", r"\bbug\b", r"\bwhy\s+does\b", r"\bwhy\s+is\b", r"\bwhy\s+do\b", r"\bdoesn.t\s+work\b", r"\bnot\s+working\b",
    r"\bproblem\b", r"\bissue\b", r"\btroubleshoot\b", r"\bslow\b.*\bperformance\b", r"\bperformance\b.*\bslow\b", r"\bcook\s+time\b",
]
CONCEPT_SIGNALS = [r"\bwhat\s+is\b", r"\bintroduction\b", r"\boverview\b", r"\bexplain\b", r"\bunderstand\b", r"\bbasic(?:s|ally)?\b", r"\bconcept\b", r"\btheory\b"]
DISCUSSION_SIGNALS = [r"\bopinion\b", r"\bpersonally\b", r"\bi\s+think\b", r"\bforum\b", r"\bquestion\b.*\banswer\b", r"\bpros?\b.*\bcons?\b", r"\btrade.?off\b"]

# Difficulty signals.
EXPERT_SIGNALS = ["solver", "compile", "opencl", "thread", "parallel", "gas_", "microsolver", "dopfield", "cvex_bsdf", "bsdf", "renderstate", "agentrig", "agentclip"]
ADVANCED_SIGNALS = [
    "pcopen", "pcfind", "pcfilter", "pcclose", "pcimport", "pcexport", "matrix", "matrix3", "quaternion", "dihedral", "qconvert", "intrinsic", "setprimintrinsic", "primintrinsic",
    "getbbox_size", "getbbox_center", "volumesample", "volumegradient", "volumeres", "foreach", "while(", "for(int", "addpoint", "addprim", "removeprim", "removepoint",
    "primuv", "xyzdist", "uvsample", "cracktransform", "maketransform", "instance", "nearpoints", "neighbourcount", "curlnoise", "flownoise",
]
INTERMEDIATE_SIGNALS = [
    "ch(", "chf(", "chi(", "chv(", "chramp(", "ramp", "noise", "rand(", "random(", "fit(", "fit01(", "clamp(", "nearpoint(", "neighbour(", "length(", "normalize(", "dot(", "cross(",
    "lerp(", "smooth(", "set(", "vector(", "point(", "prim(", "detail(", "setpointattrib(", "setprimattrib(",
]
LOCAL_ADVANCED = ["pcopen", "pcfind", "pcfilter", "matrix", "quaternion", "dihedral", "solver", "intrinsic", "setprimintrinsic", "compile", "thread", "getbbox_size", "volumesample", "volumegradient"]
LOCAL_INTERMEDIATE = ["foreach", "for(", "while(", "ramp", "chramp", "noise", "curlnoise", "addpoint", "addprim", "removeprim", "nearpoint", "pcclose"]

# Execution contexts.
CONTEXT_SIGNALS = {
    "dop": ["@Frame", "@Time", "@TimeInc", "@Timescale", "dopfield", "gas_", "microsolver", "solver", "pop", "@age", "@life", "@dead", "fluidobject", "emitter"],
    "cop": ["@IX", "@IY", "@IR", "@IG", "@IB", "@IA", "cinput", "copinput", "colormap("],
    "chop": ["@Channel", "chinput(", "chopinput(", "sample_rate"],
    "cvex": ["cvex_bsdf", "bsdf(", "renderstate(", "rayhittest(", "gather(", "trace("],
    "material": ["surface(", "displacement(", "texture(", "environment(", "@uv", "teximport(", "diffuse(", "specular(", "computelighting("],
    "solver": ["solver", "prev_frame", "solverresult"],
}
SOP_SIGNALS = ["@P", "@Cd", "@N", "@ptnum", "point(", "prim(", "npoints"]
LOCAL_CONTEXTS = [
    ("dop", ["@Frame", "@Time", "@TimeInc", "dopfield", "gas_"]),
    ("dop", ["@voxelsize", "volumesample", "volumegradient"]),
    ("material", ["@uv", "texture(", "colormap("]),
    ("chop", ["@Channel", "chinput("]),
]

# Version rules (pattern, version, note).
VERSION_RULES = [
    (r"@opinput\d+_", "16.0", "Uses @opinputN_ syntax (deprecated in H17+)"),
    (r"\bchramp\b", "15.0", "chramp() available since H15"),
    (r"\bpcfind_radius\b", "17.0", "pcfind_radius() added in H17"),
    (r"\bsetprimintrinsic\b", "15.0", "setprimintrinsic() available since H15"),
    (r"\bdetailintrinsic\b", "15.5", "detailintrinsic() available since H15.5"),
    (r"\binpointgroup\b", "14.0", "inpointgroup() has been available since early versions"),
    (r"\bdict\b", "18.0", "VEX dict type added in H18"),
    (r"\bforeach\s*\(\s*int\b", "16.5", "Typed foreach added in H16.5"),
    (r"\binstance\b", "19.0", "instance() intrinsic workflow common in H19+"),
    (r"\bnearpoints\b", "15.0", "nearpoints() available since H15"),
    (r"\busd_", "19.0", "USD VEX functions added in H19+"),
    (r"\bosd_limitSurface\b", "21.0", "osd_limitSurface() added in H21"),
]

# Topics by indicators, and names that mean a topic.
TOPIC_SIGNALS = {
    "noise_patterns": ["noise", "onoise", "snoise", "anoise", "curlnoise", "pnoise"],
    "point_cloud_ops": ["pcopen", "pcfind", "pcclose", "pcfilter", "pcimport", "pcgenerate", "nearpoints", "nearpoint", "pgfind"],
    "channel_references": ["ch(", "chf(", "chi(", "chv(", "chs(", "chramp("],
    "color_operations": ["@Cd", "hsvtorgb", "rgbtohsv", "luminance"],
    "matrix_transforms": ["maketransform", "invert(", "transpose(", "ident(", "matrix3", "matrix4", "rotate(", "scale("],
    "quaternion_operations": ["quaternion(", "qrotate(", "slerp(", "eulertoquaternion", "qconvert", "dihedral("],
    "geometry_creation": ["addpoint(", "addprim(", "addvertex(", "removeprim(", "removepoint(", "setprimvertex("],
    "loop_patterns": ["for (", "for(", "foreach(", "while(", "while ("],
    "edge_topology": ["hedge_", "vertexpoint(", "vertexprim(", "pointvertex(", "primvertex(", "vertexnext(", "vertexprev(", "neighbours(", "polyneighbours("],
    "attribute_operations": ["setpointattrib(", "setprimattrib(", "setdetailattrib(", "setvertexattrib(", "attrib(", "point(", "prim(", "detail("],
    "math_operations": ["fit(", "fit01(", "clamp(", "lerp(", "smooth(", "abs(", "floor(", "ceil(", "pow(", "sqrt(", "sin(", "cos(", "atan2(", "radians(", "degrees("],
    "conditional_logic": ["if (", "if(", "else", "ternary"],
    "simulation_setup": ["solver", "@Frame", "@Time", "@TimeInc"],
    "string_operations": ["sprintf(", "split(", "join(", "strlen(", "substr("],
    "flow_visualization": ["advect", "curl", "streamline"],
}
TOPIC_NAMES = {
    "point cloud operations": "point_cloud_ops",
    "point cloud operations (pcopen, pcfind)": "point_cloud_ops",
    "point cloud operations and aggregation": "point_cloud_ops",
    "point cloud operations, optimization patterns": "point_cloud_ops",
    "flow visualization": "flow_visualization",
    "geometry creation": "geometry_creation",
    "geometry creation and intersection": "geometry_creation",
    "geometry creation and manipulation": "geometry_creation",
    "edge topology": "edge_topology",
    "edge topology, edge operations": "edge_topology",
    "attribute operations": "attribute_operations",
    "string operations": "string_operations",
    "array operations": "attribute_operations",
    "vector operations": "math_operations",
    "mesh operations": "geometry_creation",
    "mesh manipulation": "geometry_creation",
    "ray tracing": "geometry_creation",
    "scattered points on limit surface": "subdivision_surfaces",
}
POINT_CLOUD_CALLS = ["pcopen", "pcfind", "pcclose", "pcfilter", "pcimport", "pcgenerate", "nearpoints"]
POINT_CLOUD_TOPIC = ["pcopen", "pcfind", "pcclose", "pcfilter", "pcimport", "pcgenerate", "nearpoints", "nearpoint", "pgfind"]

# Names of functions that count as calls in any case.
KNOWN_CALLS = [
    # mathematics
    "abs", "ceil", "floor", "round", "clamp", "fit", "fit01", "fit10", "fit11", "lerp", "slerp", "smooth", "efit", "min", "max", "pow", "sqrt", "log", "exp",
    "sin", "cos", "tan", "asin", "acos", "atan", "atan2", "radians", "degrees", "sign", "frac", "trunc",
    # vectors
    "length", "normalize", "dot", "cross", "distance", "reflect", "set", "getcomp", "setcomp",
    # noise
    "noise", "snoise", "onoise", "pnoise", "curlnoise", "curlnoise2d", "anoise", "xnoise", "flownoise", "random", "rand", "nrandom",
    # point clouds
    "pcopen", "pcfind", "pcfind_radius", "pcclose", "pcfilter", "pciterate", "pcunshaded", "pcimport", "pcexport", "pcnumfound", "nearpoint", "nearpoints", "neighbour", "neighbours", "neighbourcount",
    # geometry
    "point", "prim", "vertex", "detail", "setpointattrib", "setprimattrib", "setvertexattrib", "setdetailattrib", "addpoint", "addprim", "addvertex", "removeprim", "removepoint",
    "npoints", "nprimitives", "nvertices", "pointattrib", "primattrib", "vertexattrib", "detailattrib", "attribsize", "attribtype", "haspointattrib", "hasprimattrib", "hasvertexattrib", "hasdetailattrib", "primuv", "xyzdist",
    # intrinsics and bounds
    "primintrinsic", "setprimintrinsic", "pointintrinsic", "detailintrinsic",
    "getbbox", "getbbox_size", "getbbox_center", "getbbox_min", "getbbox_max", "getpointbbox", "getpointbbox_size", "getpointbbox_center",
    # transforms
    "ident", "invert", "transpose", "determinant", "translate", "rotate", "scale", "maketransform", "cracktransform", "quaternion", "dihedral", "qconvert", "lookat", "instance", "orient",
    # strings
    "sprintf", "printf", "concat", "strlen", "substr", "find", "replace", "split", "join", "strip", "lstrip", "rstrip", "upper", "lower", "itoa", "atoi", "atof",
    # channels
    "ch", "chf", "chi", "chv", "chs", "chp", "chramp", "chrampf",
    # arrays
    "len", "resize", "append", "pop", "push", "insert", "removevalue", "removeindex", "sort", "reverse", "reorder", "argsort", "array", "find", "foreach",
    # volumes
    "volumesample", "volumesamplev", "volumegradient", "volumeres", "volumeindex", "volumeindextopos", "volumepostoindex",
    # groups
    "inpointgroup", "inprimgroup", "invertexgroup", "setpointgroup", "setprimgroup", "setvertexgroup", "npointsgroup", "nprimitivesgroup",
    # others
    "assert", "error", "warning", "printf", "getattrib", "setattrib", "import", "sample_direction_uniform", "sample_hemisphere", "dopfield", "solverresult", "texture", "colormap",
    "vector", "float", "int", "string", "matrix", "matrix3",
]

# Navigation lines of wiki pages, and what tells that inline code is a snippet.
NAVIGATION = r"^\s*(prev|this|next)\s*:"
INLINE_SNIPPET = r"@\w+|ch[fivs]?\(|point\(|prim\(|set\w+attrib\(|pcopen\(|pcfind\(|nearpoints?\(|addpoint\(|addprim\(|\bvector\b|\bfloat\b|\bint\b|\bforeach\b"

# Contexts by a word of the category that a function is listed under.
CATEGORY_CONTEXTS = {
    "any": ["sop", "dop", "cop", "chop", "cvex", "material"],
    "shading": ["material"],
    "cop": ["cop"],
    "chop": ["chop"],
    "sop": ["sop"],
    "dop": ["dop"],
    "cvex": ["cvex"],
    "fog": ["material"],
    "surface": ["material"],
    "displacement": ["material"],
    "light": ["material"],
}

# Words before a bracket that are no calls, casts, and deprecated syntax.
NOT_CALLS = ["if", "else", "for", "while", "do", "return", "break", "continue", "switch", "case", "default", "struct", "typedef", "define", "include", "pragma", "foreach"]
CASTS = ["vector", "float", "int", "string", "matrix", "matrix3"]
DEPRECATED = [(r"@opinput(\d+)_", "Deprecated @opinputN_ syntax (pre-H17). Use opinput() or input index."), (r"\bgetglobalvariable\b", "getglobalvariable() is deprecated.")]
READ_ONLY = ["ptnum", "numpt", "numprim"]

# What introduces a concept, and which calls need one.
CONCEPT_INTROS = {
    "attributes": r"\b(?:what\s+(?:is|are)\s+)?attributes?\b.*@",
    "vectors": r"\bvectors?\b.*(?:xyz|component|direction)",
    "noise": r"\bnoise\b.*(?:random|procedural|pattern)",
    "loops": r"\b(?:for|while|foreach)\b.*\b(?:loop|iterate)",
    "point_clouds": r"\bpoint\s*cloud\b|\bpcopen\b|\bpcfind\b",
    "matrices": r"\bmatr(?:ix|ices)\b.*(?:transform|rotate|scale)",
    "solver": r"\bsolver\b.*(?:sop|frame|prev)",
    "volumes": r"\bvolume\b.*(?:voxel|sample|field)",
    "groups": r"\bgroup\b.*(?:point|prim|vertex)",
    "intrinsics": r"\bintrinsic\b.*(?:prim|bound|area)",
    "uv": r"\buv\b.*(?:coord|map|unwrap|texture)",
    "ramps": r"\bramp\b.*(?:color|float|gradient)",
    "channels": r"\b(?:ch|chf|chi|chv)\b.*(?:param|slider|channel)",
}
CALL_CONCEPTS = {
    "pcopen": "point_clouds", "pcfind": "point_clouds", "pcfind_radius": "point_clouds", "pcfilter": "point_clouds", "pcclose": "point_clouds", "pcimport": "point_clouds",
    "nearpoint": "point_clouds", "nearpoints": "point_clouds", "neighbour": "point_clouds", "neighbours": "point_clouds",
    "noise": "noise", "snoise": "noise", "onoise": "noise", "curlnoise": "noise", "flownoise": "noise", "xnoise": "noise",
    "matrix": "matrices", "invert": "matrices", "transpose": "matrices", "cracktransform": "matrices", "maketransform": "matrices", "quaternion": "matrices", "dihedral": "matrices",
    "volumesample": "volumes", "volumesamplev": "volumes", "volumegradient": "volumes", "volumeres": "volumes",
    "chramp": "ramps", "chrampf": "ramps",
    "ch": "channels", "chf": "channels", "chi": "channels", "chv": "channels",
    "inpointgroup": "groups", "setpointgroup": "groups", "inprimgroup": "groups", "setprimgroup": "groups",
    "primintrinsic": "intrinsics", "setprimintrinsic": "intrinsics", "detailintrinsic": "intrinsics",
    "primuv": "uv", "uvsample": "uv",
}

# Wiki pages by name: their labels, the numbered ones, and the one that is not for beginners.
PAGE_LABELS = {"HoudiniVex": "HoudiniVex Tips", "JoyOfVex": "Joy of VEX Index"}
DAY_PAGE, DAY_LABEL = r"^JoyOfVex(\d+)", "Joy of VEX Day "
MIDDLE_PAGES = ["HoudiniVex"]

# How a page names an episode.
MENTION = r"(?i)(?:joy\s*of\s*vex|jov)\s*(\d+)"

# Legacy difficulty words.
DIFFICULTIES = ["beginner", "intermediate", "advanced", "expert"]
DIFFICULTY_WORDS = {"simple": "beginner", "easy": "beginner", "moderate": "intermediate", "medium": "intermediate", "hard": "advanced", "complex": "advanced", "very hard": "expert"}
COMPLEXITY_WORDS = {"simple": "O(1)", "moderate": "O(n)", "complex": "O(n^2)"}
CONTEXT_WORDS = {"dop": "dop", "cop": "cop", "chop": "chop", "cvex": "cvex", "material": "material", "shader": "material", "solver": "solver"}
