"""HTML expressions: cleaning, structure, links.

Cleaning is an ordered chain of regular expressions in the JVM. Pages whose noise elements nest in
themselves or are never closed, which no regular expression can pair up, are told by what the chain
leaves over; only they are read as a tree, in Arrow batches. General CSS selection needs a tree too.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, bisect_right
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaglio.functions.text import SPACE, let, strip

#: Elements that hold no content.
NOISE = ("script", "style", "noscript", "iframe", "svg", "canvas", "nav", "footer", "header", "form")
MAX_CHARS = 24_000
HEAD_CHARS = 500

#: Marks of content management systems, in the order they are tried.
PLATFORMS = (("drupal", "drupal"), ("wordpress", "wordpress|wp-content"), ("joomla", "joomla"), ("liferay", "liferay"), ("typo3", "typo3"), ("plone", "plone"), ("bootstrap-italia", "bootstrap-italia"))
#: Fixed value: class names that a build made.
HASHED = r"__[A-Za-z0-9]{5,}$|^css-[a-z0-9]{5,}$|_[a-f0-9]{6,}$"

#: Names that stand without a semicolon too, the longest first.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: What is read first: the names of Latin text.
_COMMON = {n: s for n, s in html5.items() if n.endswith(";") and n[:-1] in html5} | {f"{n};": html5[f"{n};"] for n in "rsquo lsquo ldquo rdquo ndash mdash hellip euro bull apos rsaquo lsaquo trade".split()}


def _table(of: dict) -> Column:
    """A fixed map, as one literal that the optimizer folds: thousands of literals would make plans slow."""
    return F.from_json(F.lit(json.dumps(of)), "MAP<STRING, STRING>")


def _sign(code: Column) -> Column:
    """The character of a number; the replacement character for none, what Windows means by 128 to 159."""
    windows = {k: bytes([k]).decode("cp1252", "replace") for k in range(0x80, 0xA0) if bytes([k]).decode("cp1252", "replace") != "�"}
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    none = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF) | code.isNull()
    return F.when(none, F.lit("�")).otherwise(F.coalesce(F.try_element_at(_table(windows), code.cast("string")), plain))


def unescape(c: Column) -> Column:
    """c with its character references read: numbers, all names of HTML 5, and the old names without semicolon. Null for null."""
    number = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"

    def read(piece: Column) -> Column:
        digits = F.regexp_extract(piece, number, 0)
        name = F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]*;", 0)
        bare = F.regexp_extract(piece, f"^(?:{_BARE})", 0)
        hexed = F.regexp_extract(piece, r"^#[xX]0*([0-9a-fA-F]{1,7})", 1)
        value = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(F.regexp_extract(piece, r"^#0*([0-9]{1,8})(?![0-9])", 1)).try_cast("int")
        zero = F.when(F.rlike(digits, F.lit(r"^#[xX]?0+;?$")), F.lit(0)).otherwise(value)
        named = F.coalesce(F.try_element_at(_table(_COMMON), name), F.try_element_at(_table({n: s for n, s in html5.items() if n.endswith(";")}), name))
        rest = lambda head: F.substr(piece, F.length(head) + 1)
        return (
            F.when(digits != "", F.concat(_sign(zero), rest(digits)))
            .when((name != "") & named.isNotNull(), F.concat(named, rest(name)))
            .when(bare != "", F.concat(F.try_element_at(_table({n: s for n, s in html5.items() if not n.endswith(";")}), bare), rest(bare)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    whole = let(F.split(c, "&"), lambda p: F.concat(p[0], F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), read), "")))
    return F.when(F.contains(c, F.lit("&")), whole).otherwise(c)


def without(c: Column, names: tuple[str, ...], by: str = "\n") -> Column:
    """c without the elements of these names; an element goes from its start tag to the next end tag of its name."""
    for name in names:
        c = F.regexp_replace(c, rf"(?is)<{name}(?:\s[^>]*)?>.*?</{name}\s*>", by)
    return c


@F.pandas_udf(T.StringType())
def _text_of_tree(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: None if p is None else tree_text(p))


def tree_text(page: str) -> str:
    """The lines of a page's text outside of noise elements, as visible_text(), read off its tree."""
    tree = parse(page)
    n = len(tree.tag)
    hidden = [False] * n
    for k in range(1, n):
        hidden[k] = hidden[tree.parent[k]] or tree.tag[k] in NOISE or tree.tag[k] in ("head", "title")
    lines = (line.strip() for node, piece in zip(tree.piece_of, tree.pieces) if not hidden[node] for line in piece.split("\n"))
    return "\n".join(line for line in lines if line)


def visible_text(html: Column) -> Column:
    """Text of the body, one node a line, lines stripped and none blank, whole. Null for null."""
    c = without(F.regexp_replace(html, r"(?s)<!--.*?-->", ""), NOISE)
    left_over = F.rlike(c, F.lit(rf"(?i)</?(?:{'|'.join(NOISE)})[\s/>]"))
    body = F.regexp_extract(c, r"(?is)<body(?:\s[^>]*)?>(.*?)(?:</body\s*>|$)", 1)
    c = F.when(c.rlike(r"(?i)<body[\s>]"), body).otherwise(without(c, ("head", "title")))
    c = unescape(F.regexp_replace(c, r"<[^>]*>", "\n"))
    lines = F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), "\n")
    return F.coalesce(_text_of_tree(F.when(left_over, html)), lines)


def clean_html(html: Column, max_chars: int = MAX_CHARS) -> Column:
    """text (cut to max_chars), original_bytes, text_length (after the cut), truncated. A null page is null."""
    return F.when(html.isNotNull(), let(visible_text(html), lambda t: F.struct(
        F.substring(t, 1, max_chars).alias("text"), F.octet_length(html).alias("original_bytes"),
        F.least(F.length(t), F.lit(max_chars)).alias("text_length"), (F.length(t) > max_chars).alias("truncated"),
    )))


def diagnostics(page: Column) -> Column:
    """What is kept of a cleaned page for diagnosis."""
    return F.struct(page["original_bytes"].alias("fetched_bytes"), page["text_length"].alias("cleaned_text_length"), page["truncated"].alias("truncated"), F.substring(page["text"], 1, HEAD_CHARS).alias("cleaned_text_head"))


#: The attributes of a tag, whatever its quotes hold.
_INSIDE = r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)"


def attribute(inside: Column, name: str) -> Column:
    """The value of an attribute in a tag's inside, in any quotes or none; '' if it is not there."""
    pattern = rf"(?is)(?:^|[\s\"'/]){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.concat(*[F.regexp_extract(inside, pattern, k) for k in (1, 2, 3)])


def platform(html: Column) -> Column:
    """The platform that a generator tag names, else the first 20,000 characters do; 'unknown' if neither does."""
    metas = F.regexp_extract_all(html, F.lit(rf"(?is)<meta\b{_INSIDE}>"), F.lit(1))
    said = F.array_join(F.transform(F.filter(metas, lambda m: F.lower(attribute(m, "name")) == "generator"), lambda m: attribute(m, "content")), "\n")
    head = F.substring(html, 1, 20_000)
    found = F.lit(None).cast("string")
    for source in (head, said):
        for name, mark in reversed(PLATFORMS):
            found = F.when(source.rlike(f"(?i){mark}"), F.lit(name)).otherwise(found)
    return F.coalesce(found, F.lit("unknown"))


def stable_class(name: Column) -> Column:
    """Whether a class name tells structure: long enough, no state, not made by a build."""
    return (F.length(name) > 2) & ~name.rlike("^(js-|is-|has-)") & ~name.rlike(HASHED)


def classes(html: Column) -> Column:
    """All class names of div, li, article and section elements, with repeats, in any quotes or none."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)<(?:div|li|article|section)(?=\s){_INSIDE}>"), F.lit(1))
    values = F.transform(tags, lambda t: unescape(attribute(t, "class")))
    return F.filter(F.flatten(F.transform(values, lambda v: F.split(v, f"{SPACE}+"))), lambda x: x != "")


#: Elements that tell a model nothing of a page's structure, and controls of forms.
MUTE = ("script", "style", "svg", "noscript")
MUTE_FOR_INFERENCE = ("select", "head")
CONTROLS = ("option", "button", "label", "input")
STUB = 40
INFERENCE_CHARS, DRAFT_CHARS = 18_000, 16_000


def condense(html: Column, inference: bool = True) -> Column:
    """Structure of a page for a model, blanks collapsed, cut to a length. Null for null.

    Text of STUB characters or more is kept as a stub. For inference tags keep class, id and href in double
    quotes and lose all else, form controls go; for drafting tags stay as they are. The page is split at its
    tags and each piece, a tag and the text behind it, is rewritten by itself, in the JVM.
    """
    c = without(html, (*MUTE, *(MUTE_FOR_INFERENCE if inference else ())), "")
    if inference:
        c = without(c, CONTROLS, "")

    def stub(text: Column) -> Column:
        return F.when(F.length(text) >= STUB, F.concat(F.substring(text, 1, STUB), F.lit("…"))).otherwise(text)

    def piece(p: Column) -> Column:
        tag = F.substring_index(p, ">", 1)
        text = F.substr(p, F.length(tag) + 2)
        name = F.regexp_extract(tag, r"^[a-zA-Z][a-zA-Z0-9]*", 0)
        if inference:
            kept = F.regexp_extract_all(tag, F.lit(r"\b((?:class|id|href)=\"[^\"]*\")"), F.lit(1))
            slim = F.when((name == "") | ~tag.rlike(r"^[a-zA-Z0-9]+\s"), tag).otherwise(F.concat_ws(" ", name, F.array_join(F.filter(kept, lambda k: k != ""), " ")))
            slim = F.rtrim(slim)
            control = F.lower(name).isin(*CONTROLS)
            return F.when(~F.contains(p, F.lit(">")), F.concat(F.lit("<"), p)).when(control, stub(text)).otherwise(F.concat(F.lit("<"), slim, F.lit(">"), stub(text)))
        return F.when(~F.contains(p, F.lit(">")), F.concat(F.lit("<"), p)).otherwise(F.concat(F.lit("<"), tag, F.lit(">"), stub(text)))

    # the text behind the last tag ends with the page, not with a tag: it is no node between tags and stays whole
    whole = let(F.split(c, "<"), lambda p: F.concat(p[0], F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), piece), "")))
    return F.substring(F.regexp_replace(whole, rf"{SPACE}+", " "), 1, INFERENCE_CHARS if inference else DRAFT_CHARS)


class Tree(HTMLParser):
    """A flat tree in document order: each element's tag, attributes, parent, last descendant and place among its siblings."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
    #: Start tags that close an open element of these names, up to a boundary.
    CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
    BOUND = frozenset("ul ol dl table body html div section article".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.attributes, self.parent = ["#"], [{}], [-1]
        self.open = [0]
        self.pieces: list[str] = []
        self.piece_of: list[int] = []
        self.first_piece, self.last_piece = [0], [0]

    def handle_starttag(self, tag, attrs):
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[depth]]
            if name in self.CLOSES.get(tag, ()):
                self._close(depth)
                break
            if name in self.BOUND:
                break
        self.tag.append(tag)
        self.attributes.append({k: v or "" for k, v in attrs})
        self.parent.append(self.open[-1])
        self.first_piece.append(len(self.pieces))
        self.last_piece.append(len(self.pieces))
        if tag not in self.VOID:
            self.open.append(len(self.tag) - 1)

    def _close(self, depth):
        for node in self.open[depth:]:
            self.last_piece[node] = len(self.pieces)
        del self.open[depth:]

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                self._close(depth)
                break

    def handle_data(self, data):
        self.pieces.append(data)
        self.piece_of.append(self.open[-1])

    def finish(self) -> Tree:
        self._close(0)
        n = len(self.tag)
        self.end, self.place, self.siblings, self.before = list(range(n)), [0] * n, [0] * n, [-1] * n
        count, last = [0] * n, [-1] * n
        for k in range(1, n):
            p = self.parent[k]
            count[p] += 1
            self.place[k], self.before[k], last[p] = count[p], last[p], k
        for k in range(n - 1, 0, -1):
            self.end[self.parent[k]] = max(self.end[self.parent[k]], self.end[k])
            self.siblings[k] = count[self.parent[k]]
        self.anchors = [k for k in range(1, n) if self.tag[k] == "a"]
        return self

    def text(self, node: int) -> str:
        """The text in an element, its pieces stripped."""
        return "".join(t.strip() for t in self.pieces[self.first_piece[node] : self.last_piece[node]])


def parse(page: str) -> Tree:
    tree = Tree()
    tree.feed(page)
    tree.close()
    return tree.finish()


_SIMPLE = re.compile(r"^(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+|\[[\w-]+(?:[~^$*|]?=[\"']?[^\]\"']*[\"']?)?\]|:[\w-]+(?:\([^)]*\))?)*)$")
_PIECE = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(?:([~^$*|]?=)[\"']?([^\]\"']*)[\"']?)?\]|:([\w-]+)(?:\(([^)]*)\))?")
_NTH = re.compile(r"^([+-]?\d*)n(?:([+-]\d+))?$")


def _nth(argument: str, place: int) -> bool:
    """Whether a place is named by an argument of nth-child."""
    text = {"odd": "2n+1", "even": "2n"}.get(argument.strip(), argument.replace(" ", ""))
    if re.fullmatch(r"[+-]?\d+", text):
        return place == int(text)
    m = _NTH.match(text)
    if not m:
        raise ValueError(f"place {argument!r}")
    step = int(m[1] + "1") if m[1] in ("", "+", "-") else int(m[1])
    off = place - int(m[2] or 0)
    return off == 0 if step == 0 else off % step == 0 and off // step >= 0


def _fits(tree: Tree, node: int, simple: str) -> bool:
    m = _SIMPLE.match(simple)
    if not m:
        raise ValueError(f"selector {simple!r}")
    if m[1] and m[1] != "*" and m[1].lower() != tree.tag[node]:
        return False
    a = tree.attributes[node]
    for kind, name, key, how, value, pseudo, argument in _PIECE.findall(m[2] or ""):
        if kind == "." and name not in a.get("class", "").split():
            return False
        if kind == "#" and a.get("id") != name:
            return False
        if key:
            have = a.get(key.lower())
            if have is None:
                return False
            ok = {"": True, "=": have == value, "~=": value in have.split(), "^=": have.startswith(value), "$=": have.endswith(value), "*=": value in have, "|=": have == value or have.startswith(value + "-")}
            if not ok[how]:
                return False
        if pseudo:
            place, of = tree.place[node], tree.siblings[node]
            told = {"first-child": place == 1, "last-child": place == of, "only-child": of == 1}
            if pseudo == "nth-child":
                told["nth-child"] = _nth(argument, place)
            if pseudo == "nth-last-child":
                told["nth-last-child"] = _nth(argument, of + 1 - place)
            if pseudo not in told:
                raise ValueError(f"pseudo class {pseudo!r}")
            if not told[pseudo]:
                return False
    return True


def _matches(tree: Tree, node: int, steps: list[str]) -> bool:
    if not _fits(tree, node, steps[-1]):
        return False
    if len(steps) == 1:
        return True
    how, rest = steps[-2], steps[:-2]
    if how == ">":
        return tree.parent[node] > 0 and _matches(tree, tree.parent[node], rest)
    if how == "+":
        return tree.before[node] > 0 and _matches(tree, tree.before[node], rest)
    step = tree.before if how == "~" else tree.parent
    at = step[node]
    while at > 0:
        if _matches(tree, at, rest):
            return True
        at = step[at]
    return False


def select(page: str, selector: str) -> tuple[Tree, list[int]]:
    """The tree and the nodes that a selector (type, class, id, attribute, child, sibling, descendant, place, list) matches, in order."""
    tree = parse(page)
    return tree, matched(tree, selector)


def matched(tree: Tree, selector: str) -> list[int]:
    found: set[int] = set()
    for one in selector.split(","):
        steps: list[str] = []
        for token in re.findall(r"[>+~]|(?:\[[^\]]*\]|\([^)]*\)|[^\s>+~\[(])+", one):
            if token not in ">+~" and steps and steps[-1] not in ">+~":
                steps.append(" ")
            steps.append(token)
        if not steps or steps[-1] in ">+~" or steps[0] in ">+~":
            raise ValueError("empty selector")
        for simple in steps[::2]:
            if not _SIMPLE.match(simple):
                raise ValueError(f"selector {simple!r}")
        found |= {k for k in range(1, len(tree.tag)) if _matches(tree, k, steps)}
    return sorted(found)


def anchors_in(tree: Tree, node: int) -> list[int]:
    """The anchor that a node is, or the anchors in it."""
    if tree.tag[node] == "a":
        return [node]
    return tree.anchors[bisect_right(tree.anchors, node) : bisect_left(tree.anchors, tree.end[node] + 1)]


def links(page: str, selector: str) -> list[tuple[str, str | None]]:
    """href and text of each anchor that is matched or lies in a match; nested matches repeat their anchors."""
    tree, nodes = select(page, selector)
    out = []
    for node in nodes:
        for k in anchors_in(tree, node):
            href = tree.attributes[k].get("href")
            if href and not href.startswith(("#", "javascript:", "mailto:", "tel:")):
                out.append((href, tree.text(k) or None))
    return out
