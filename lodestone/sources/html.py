"""Markup to chunks, links and reference pages: the standard library's parser in table functions, joined laterally to pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions import packs as P
from ..functions import text as T

HEADINGS = ("h1", "h2", "h3", "h4")
_NAV = re.compile(P.NAVIGATION, re.I)
_CODE = re.compile(P.INLINE_SNIPPET)
_SPACE = re.compile(r"\s+")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_UNSEEN = {"script", "style", "head", "template"}


class Node:
    """An element: its children are elements and strings."""

    __slots__ = ("tag", "attrs", "children", "parent", "gone")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None = None) -> None:
        self.tag, self.attrs, self.children, self.parent, self.gone = tag, attrs, [], parent, False

    def walk(self) -> Iterator[Node | str]:
        """Everything below, in document order, with a stack of its own, so that depth is no concern."""
        stack: list[Node | str] = self.children[::-1]
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                if x.gone:
                    continue
                yield x
                stack.extend(x.children[::-1])
            else:
                yield x

    def find(self, *tags: str) -> Iterator[Node]:
        return (x for x in self.walk() if isinstance(x, Node) and x.tag in tags)

    def strings(self) -> list[str]:
        return [x for x in self.walk() if isinstance(x, str)]

    def text(self) -> str:
        return "".join(self.strings())

    def joined(self) -> str:
        """Its strings, stripped and joined by spaces, white space folded."""
        return _SPACE.sub(" ", " ".join(s for x in self.strings() if (s := x.strip()))).strip()

    def compact(self) -> str:
        """Its strings, stripped and joined."""
        return "".join(x.strip() for x in self.strings())

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()

    def drop(self) -> None:
        """Out of what its ancestors walk from now on."""
        self.gone = True


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("", {})
        self.quiet = 0
        self.open: Counter[str] = Counter()  # elements that are open, so that an end without a start costs nothing

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _UNSEEN:
            self.quiet += 1
        if self.quiet:
            return
        node = Node(tag, dict(attrs), self.here)
        self.here.children.append(node)
        if tag not in _VOID:
            self.here = node
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if not self.quiet:
            self.here.children.append(Node(tag, dict(attrs), self.here))

    def handle_endtag(self, tag: str) -> None:
        if tag in _UNSEEN:
            self.quiet = max(0, self.quiet - 1)
            return
        if self.quiet or not self.open[tag]:
            return
        while self.here.tag != tag:
            self._close()
        self._close()

    def _close(self) -> None:
        self.open[self.here.tag] -= 1
        self.here = self.here.parent

    def handle_data(self, data: str) -> None:
        if not self.quiet:
            self.here.children.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _parts(root: Node) -> Iterator[Node | str]:
    """The elements that count as a page's own: those of the top, and those of elements that hold headings."""
    holders: set[int] = set()
    for x in root.find(*HEADINGS):
        while (x := x.parent) is not None and id(x) not in holders:
            holders.add(id(x))
    stack: list[Node | str] = root.children[::-1]
    while stack:
        x = stack.pop()
        if isinstance(x, Node) and x.tag not in HEADINGS and (x.tag in ("html", "body") or id(x) in holders):
            stack.extend(x.children[::-1])
        else:
            yield x


def is_navigation(text: str) -> bool:
    text = text.strip()
    return len(text) < 150 and _NAV.match(text) is not None


def sections(html: str | None, heading: str = "") -> list[tuple[str, str, list[str]]]:
    """(heading, prose, codes) of the sections between headings of levels 1 to 4; empty ones and navigation are left out.

    Codes are pre elements, also nested ones, and inline code of several lines that looks like a snippet; the rest is
    prose, its paragraphs set apart by blank lines.
    """
    out: list[tuple[str, str, list[str]]] = []
    prose: list[str] = []
    codes: list[str] = []

    def flush() -> None:
        text = "\n\n".join(prose)
        if codes or (text and not is_navigation(text)):
            out.append((heading, text, codes.copy()))
        prose.clear()
        codes.clear()

    for x in _parts(parse(html)):
        if isinstance(x, str):
            if x.strip():
                prose.append(x.strip())
        elif x.tag in HEADINGS:
            flush()
            heading = x.text()
        else:
            wrapped = x.tag == "div" and "language-" in (x.attrs.get("class") or "")
            blocks = [x] if x.tag == "pre" else list(x.find("pre"))[: 1 if wrapped else None]
            inline = [] if wrapped or x.tag == "pre" else [c for c in x.find("code") if "\n" in c.text().strip() and _CODE.search(c.text())]
            inner = {id(c) for b in blocks for c in b.find("code")}
            held = [*blocks, *(c for c in inline if id(c) not in inner)]
            codes += [t for b in held if (t := b.text().strip())]
            if not wrapped and x.tag != "pre":
                for b in held:
                    b.drop()
                text = x.joined()
                if text and not is_navigation(text):
                    prose.append(text)
    flush()
    return out


class Sections:
    """Table function of a page: seq, heading, content, codes of its sections in order; navigation and empty ones are left out."""

    def eval(self, html: str) -> Iterator[tuple]:
        for n, (heading, content, codes) in enumerate(sections(html), 1):
            yield n, heading, content, codes


class Anchors:
    """Table function of a page: href, label of each link with a label."""

    def eval(self, html: str) -> Iterator[tuple]:
        for a in parse(html).find("a"):
            if (href := a.attrs.get("href")) and (label := a.text().strip()):
                yield href, label


class IndexRows:
    """Table function of an index page: seq, name, href, category, brief of its links; a term's link comes twice, the second time with its brief."""

    def eval(self, html: str) -> Iterator[tuple]:
        for n, row in enumerate(_index(html), 1):
            yield n, *row


class Reference:
    """Table function of a function's page, by its name: signature, description, examples, parameters, related."""

    def eval(self, name: str, html: str) -> Iterator[tuple]:
        yield _reference(str(name or ""), html)


#: By the names that SQL calls them by.
TABLES = {
    "page_sections": udtf(Sections, returnType="seq int, heading string, content string, codes array<string>", useArrow=True),
    "page_anchors": udtf(Anchors, returnType="href string, label string", useArrow=True),
    "page_index": udtf(IndexRows, returnType="seq int, name string, href string, category string, brief string", useArrow=True),
    "page_reference": udtf(Reference, returnType="signature string, description string, examples array<string>, parameters array<string>, related array<string>", useArrow=True),
}


def register(spark: SparkSession) -> None:
    """Lets SQL call the table functions of pages: SELECT ... FROM pages, LATERAL page_sections(html)."""
    for name, table in TABLES.items():
        spark.udtf.register(name, table)


def _rows(pages: DataFrame, table: str, key: str, *columns: str) -> DataFrame:
    """A page's key and what a table function gives for its columns."""
    few = pages.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__c{n}") for n, c in enumerate(columns)])
    out = few.lateralJoin(TABLES[table](*[F.col(f"__c{n}").outer() for n in range(len(columns))]))
    return out.select(F.col("__key").alias(key), *[c for c in out.columns if not c.startswith("__")])


def page_chunks(pages: DataFrame, key: str = "page_id", html_col: str = "html") -> DataFrame:
    """key, seq, heading, content, codes: sections of each page in order; navigation and empty ones are left out."""
    out = _rows(pages, "page_sections", key, html_col)
    return out.withColumn("heading", T.clean_heading(F.col("heading")))


def wiki_chunks(pages: DataFrame, name_col: str = "name", html_col: str = "html", source_id: str = "wiki", base_url: str = "", authority: float = 0.95) -> DataFrame:
    """Chunks of wiki pages, titled by heading, or by the page's label before the first one."""
    c = page_chunks(pages, name_col, html_col)
    label = T.section_label(F.col(name_col))
    return c.select(
        T.sequence_id(F.concat(F.lit(f"{source_id}_"), F.lower(name_col)), F.col("seq")).alias("id"), "content", "codes", F.lit("concept").alias("content_type"), T.page_difficulty(F.col(name_col)).alias("difficulty"),
        F.array(F.lit("sop")).alias("vex_context"), F.lit(source_id).alias("source_id"), F.concat(F.lit(base_url + "/"), F.col(name_col), F.lit(".html")).alias("source_url"),
        F.lit(authority).alias("source_authority"), F.when(F.col("heading") == "", label).otherwise(F.col("heading")).alias("title"), label.alias("section"),
    )


def first_heading(html: Column) -> Column:
    """What stands in the first heading of level 1; empty if there is none."""
    return F.regexp_extract(html, r"(?s)<h1[^>]*>(.*?)</h1>", 1)


def page_number(url: Column) -> Column:
    """The last number of one or two digits in an address; null if there is none."""
    return F.nullif(F.regexp_extract(url, r"(\d{1,2})\D*$", 1), F.lit("")).cast("int")


def page_links(pages: DataFrame, key: str = "page_id", html_col: str = "html") -> DataFrame:
    """key, href, label of each link with a label."""
    return _rows(pages, "page_anchors", key, html_col)


def _index(html: str | None) -> list[tuple[str, str, str, str]]:
    """(name, href, category, brief) of an index' links, those of terms once more, with the beginning of what explains them."""
    out, category, follows = [], "", {}  # follows: of each parent, the dd after each child

    def add(link: Node | None, brief: str, far: bool) -> None:
        href, name = (link.attrs.get("href") or "", link.compact()) if link is not None else ("", "")
        if href and name and (far or not href.startswith(("#", "http"))):
            out.append((name, href if href.endswith(".html") else href + ".html", category, brief))

    for x in parse(html).find("h2", "h3", "a", "dt"):
        if x.tag in ("h2", "h3"):
            category = x.compact().lower()
        elif x.tag == "a":
            add(x, "", False)
        else:
            if id(x.parent) not in follows:
                last, mine = None, {}
                for y in reversed(x.parent.children):
                    mine[id(y)] = last
                    last = y if isinstance(y, Node) and y.tag == "dd" else last
                follows[id(x.parent)] = mine
            explained = follows[id(x.parent)][id(x)]
            add(next(x.find("a"), None), explained.compact()[:200] if explained is not None else "", True)
    return out


def function_index(pages: DataFrame, key: str = "page_id", html_col: str = "html", base_url: str = "") -> DataFrame:
    """key, seq, name, url, category, brief of the links of index pages; a term's link comes twice, the second time with its brief."""
    out = _rows(pages, "page_index", key, html_col)
    return out.select(key, "seq", "name", F.concat(F.lit(base_url + "/"), "href").alias("url"), "category", "brief")


def _reference(name: str, html: str | None) -> tuple[str, str, list[str], list[str], list[str]]:
    """Signature, description, examples, parameters and related names of a function's page."""
    root = parse(html)
    every = list(root.find("pre", "code"))
    marked = next((x for x in every if x.tag == "pre" and x.has_class("signature")), None) or next((x for x in every if x.tag == "code" and x.has_class("signature")), None)
    pres = [x.compact() for x in every if x.tag == "pre"]
    signature = marked.compact() if marked is not None else pres[0] if pres and name in pres[0] and "(" in pres[0] else ""
    body = next((x for x in root.find("div") if x.has_class("content")), None) or next(root.find("article"), None) or next(root.find("body"), None)
    said = [t for p in (body.find("p") if body is not None else ()) if len(t := p.compact()) > 10][:3]
    examples = [c for c in pres if name in c and len(c) > 20 and c != signature]
    table = next(root.find("dl"), None) or next((x for x in root.find("table") if x.has_class("parameters")), None)
    terms, meanings = ([x.compact() for x in table.find(t)] if table is not None else [] for t in ("dt", "dd"))
    parameters = [f"{a}: {b[:150]}" for a, b in zip(terms, meanings, strict=False)]
    see = next((x for x in root.find(*{n.tag for n in root.walk() if isinstance(n, Node)}) if any(isinstance(c, str) and re.search("See also|Related", c, re.I) for c in x.children)), None)
    related = [t for a in (see.find("a") if see is not None else ()) if (t := a.compact()) and t != name]
    return signature, "\n\n".join(said), examples, parameters, related


def reference_pages(pages: DataFrame, name_col: str = "name", html_col: str = "html", category: Column | None = None) -> DataFrame:
    """name, signature, return_type, description, examples, parameters, related, vex_context, content of function pages; pages with nothing to say are left out."""
    keyed = pages.select(name_col, html_col, (F.lit("") if category is None else F.coalesce(category, F.lit(""))).alias("category"))
    read = _rows(keyed, "page_reference", name_col, name_col, html_col)
    contexts = F.flatten(F.array(*[F.when(F.contains(F.lower("category"), F.lit(word)), F.array(*map(F.lit, found))).otherwise(F.array().cast("array<string>")) for word, found in P.CATEGORY_CONTEXTS.items()]))
    found = F.array_sort(F.array_distinct(contexts))
    listed = lambda c, sep: F.when(F.size(c) > 0, F.array_join(c, sep))
    content = T.join_nonempty(
        "\n\n",
        F.concat(F.lit("Signature: "), F.nullif("signature", F.lit(""))),
        F.concat(F.lit("Returns: "), F.nullif("return_type", F.lit(""))),
        F.col("description"),
        F.concat(F.lit("Parameters:\n  - "), listed(F.col("parameters"), "\n  - ")),
        F.concat(F.lit("Related: "), listed(F.col("related"), ", ")),
    )
    out = read.withColumn("return_type", T.return_type(F.col("signature"))).withColumn("content", content).where("content <> ''")
    kinds = keyed.groupBy(F.col(name_col).alias("__name")).agg(F.min("category").alias("category"))
    out = out.join(kinds, out[name_col].eqNullSafe(kinds["__name"]), "left")
    return out.select(name_col, "signature", "return_type", "description", "examples", "parameters", "related", F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("sop"))).alias("vex_context"), "content")


def indexed_pages(index: DataFrame, pages: DataFrame, key: str = "name", html_col: str = "html") -> DataFrame:
    """name, url, category, brief, html: the pages (key, html) that an index (function_index()) names, once each, with its category and the longest brief; names without a page are left out."""
    once = index.groupBy("name").agg(F.min("url").alias("url"), F.max_by("category", F.struct(F.length("category"), "category")).alias("category"), F.max_by("brief", F.struct(F.length("brief"), "brief")).alias("brief"))
    return once.join(pages.select(F.col(key).alias("name"), F.col(html_col).alias("html")), "name")


def reference_chunks(pages: DataFrame, source_id: str = "reference", base_url: str = "", name_col: str = "name", html_col: str = "html", category: Column | None = None) -> DataFrame:
    """Chunks of function pages."""
    r = reference_pages(pages, name_col, html_col, category)
    block = lambda code, role: F.struct(code.alias("code"), F.lit(role).alias("line_context"), F.lit(True).alias("is_complete"))
    none = F.array().cast("array<struct<code:string,line_context:string,is_complete:boolean>>")
    return r.select(
        F.concat(F.lit(f"{source_id}_ref_"), F.lower(name_col)).alias("id"), "content",
        F.concat(F.when(F.col("signature") != "", F.array(block(F.col("signature"), "signature"))).otherwise(none), F.transform("examples", lambda e: block(e, "example"))).alias("code_blocks"),
        F.lit("reference").alias("content_type"), F.lit("intermediate").alias("difficulty"), "vex_context", F.lit(source_id).alias("source_id"),
        F.concat(F.lit(base_url + "/"), F.col(name_col), F.lit(".html")).alias("source_url"), F.lit(1.0).alias("source_authority"), F.col(name_col).alias("title"),
        F.concat(F.array(name_col), F.slice("related", 1, 5)).alias("functions_referenced"),
    )


def saved_pages(spark: SparkSession, folder: str) -> DataFrame:
    """name, html of the pages saved in a folder, but for its indexes."""
    from .files import whole_files

    name = F.regexp_extract("path", r"([^/]+)\.html$", 1)
    return whole_files(spark, folder, ("html",), False).select(name.alias("name"), F.col("text").alias("html")).where(~F.col("name").isin("index", "_index"))


def carved_body(module: Column) -> Column:
    """The markup that a script module carries: from its first heading or paragraph to the quote that closes it; null if there is none."""
    start = F.coalesce(*[F.nullif(F.locate(tag, module), F.lit(0)) for tag in ("<h1", "<h2", "<p")])
    rest = F.substring(module, start, F.length(module))
    end = F.regexp_instr(rest, F.lit(r"""['"`],\s*\d+\)\s*,\s*\w+=\["""))
    tail = F.greatest(F.length(module) - 300, F.lit(0))
    last = F.regexp_instr(F.substring(module, tail + 1, F.lit(300)), F.lit(r"""['"`],\s*\d+\)"""))
    length = F.when(end > 0, end - 1).when(last > 0, tail + last - start)
    return F.replace(F.substring(rest, F.lit(1), length), F.lit("\\'"), F.lit("'"))


def hash_map(page: Column) -> Column:
    """map of page file to hash, from the JSON text that a page's script parses; null if there is none."""
    raw = F.nullif(F.regexp_extract(page, r'__VP_HASH_MAP__=JSON\.parse\("(.*?)"\)', 1), F.lit(""))
    return F.from_json(F.replace(F.replace(raw, F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\")), "map<string,string>")


def asset_prefix(page: Column) -> Column:
    """The folder of a page's script modules, or null."""
    return F.nullif(F.regexp_extract(page, r'modulepreload"[^>]+href="(/[^"]+/assets/)', 1), F.lit(""))
