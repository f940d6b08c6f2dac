"""URL expressions: repair, reference resolution, canonical form, hash.

All are column expressions in whole-stage codegen. A URL is split with the generic pattern of RFC 3986.
Dot segments are folded over the array of a path's segments, however deep they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaglio.functions.text import let, strip

#: Query parameters that name a campaign and not a document.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid")

#: Fixed value: the pattern of RFC 3986, appendix B.
PARTS = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(?s:.*))?$"

def part(url: Column, n: int) -> Column:
    """Group n of the URL: 1 scheme, 2 authority, 3 path, 4 query. Empty where absent."""
    return F.regexp_extract(url, PARTS, n)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def netloc(url: Column) -> Column:
    return part(url, 2)


def path(url: Column) -> Column:
    return part(url, 3)


def query(url: Column) -> Column:
    return part(url, 4)


def repair_url(url: Column) -> Column:
    """Stripped, and with a scheme that was written several times kept once."""
    return F.regexp_replace(strip(url), r"^((?i)https?://)(?:(?i)https?://)+", "$1")


def _fold_dots(p: Column) -> Column:
    """An absolute path without dot segments; those that lead above the root are dropped."""
    parts = F.slice(F.split(p, "/"), 2, F.size(F.split(p, "/")))
    empty = F.array().cast("array<string>")
    step = lambda kept, x: F.when(x == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(x == ".", kept).otherwise(F.concat(kept, F.array(x)))
    # a dot segment at the end leaves its folder, with the slash
    closed = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    return F.concat(F.lit("/"), F.array_join(F.aggregate(closed, empty, step), "/"))


def split_url(url: Column) -> Column:
    """scheme (lower case), netloc, path, query and tail (query and fragment as written) of a URL; empty where absent."""
    return F.struct(
        F.lower(part(url, 1)).alias("scheme"),
        part(url, 2).alias("netloc"),
        part(url, 3).alias("path"),
        part(url, 4).alias("query"),
        F.regexp_extract(url, r"^[^?#]*((?s:.*))$", 1).alias("tail"),
    )


def _joined(url: Column, u: Column, b: Column) -> Column:
    """url, split as u, read against the split base b."""
    root = F.concat(b["scheme"], F.lit("://"), b["netloc"])
    folder = F.when(b["path"] == "", F.lit("/")).otherwise(F.regexp_replace(b["path"], r"[^/]*$", ""))
    base_query = F.when(b["query"] == "", F.lit("")).otherwise(F.concat(F.lit("?"), b["query"]))
    dotted = u["path"].rlike(r"(^|/)\.\.?(/|$)")
    full = F.concat(folder, u["path"])
    return (
        F.when(u["scheme"] != "", url)
        .when(url.startswith("//"), F.concat(b["scheme"], F.lit(":"), url))
        .when(u["path"].startswith("/"), F.concat(root, F.when(dotted, _fold_dots(u["path"])).otherwise(u["path"]), u["tail"]))
        .when(u["path"] == "", F.concat(root, b["path"], F.when(url.startswith("?"), F.lit("")).otherwise(base_query), u["tail"]))
        .otherwise(F.concat(root, F.when(dotted, _fold_dots(full)).otherwise(full), u["tail"]))
    )


def resolve(url: Column, base: Column) -> Column:
    """The reference url read against base; url itself where base is null or empty."""
    absolute = let(F.struct(url.alias("url"), split_url(url).alias("u"), split_url(base).alias("b")), lambda x: _joined(x["url"], x["u"], x["b"]))
    return F.when(base.isNull() | (base == ""), url).otherwise(absolute)


def kept_query(q: Column) -> Column:
    """The query without empty parts and without tracking parameters, order kept."""
    return F.array_join(F.filter(F.split(q, "&"), lambda x: (x != "") & ~F.lower(F.substring_index(x, "=", 1)).isin(*TRACKING)), "&")


def _canonical(u: Column) -> Column:
    p = F.regexp_replace(u["path"], r"/+$", "")
    q = kept_query(u["query"])
    return F.concat(
        F.when(u["scheme"] == "", F.lit("")).otherwise(F.concat(u["scheme"], F.lit(":"))),
        F.when(u["netloc"] == "", F.lit("")).otherwise(F.concat(F.lit("//"), F.lower(u["netloc"]))),
        F.when(p == "", F.lit("/")).otherwise(p),
        let(q, lambda x: F.when(x == "", F.lit("")).otherwise(F.concat(F.lit("?"), x))),
    )


def canonical_url(url: Column, base: Column | None = None, base_parts: Column | None = None) -> Column:
    """Absolute, fragment-free, tracking-free URL. Null for null.

    base_parts: split_url(base) where it has been computed once for many URLs.
    """
    if base is None and base_parts is None:
        return let(repair_url(url), lambda u: let(split_url(u), _canonical))
    b = split_url(base) if base_parts is None else base_parts

    def of(u: Column) -> Column:
        def known(p: Column) -> Column:
            against = let(strip(_joined(u, p, b)), lambda full: let(split_url(full), _canonical))
            return F.when((p["scheme"] != "") | (F.coalesce(b["scheme"], F.lit("")) == ""), _canonical(p)).otherwise(against)

        return let(split_url(u), known)

    return let(repair_url(url), of)


def url_hash(canonical: Column) -> Column:
    """SHA-256 of a canonical URL."""
    return F.sha2(canonical, 256)


def truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty; the last as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])
