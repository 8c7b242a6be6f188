"""Reference resolution of URLs (relative link + base URL -> absolute URL),
as built-in column expressions.

Covers the cases of RFC 3986 section 5.2 that web pages use: absolute
references, network-path (``//host``), absolute-path (``/x``), query-only
(``?q``), fragment-only (``#f``), empty, and relative paths with ``.`` and
``..`` segments (removed by a fold over the path segments).  Like the
standard library resolver the reference uses, a merged relative path drops
empty inner segments (``a//b`` -> ``a/b``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"
_QUERY = r"^[^?#]*(\?[^#]*)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _squeeze_inner(segs: Column) -> Column:
    """Drop empty segments between the first and the last (a merged relative
    reference never keeps doubled slashes)."""
    n = F.size(segs)
    inner = F.filter(F.slice(segs, 2, n - 2), lambda x: x != "")
    return F.when(n > 2, F.concat(F.slice(segs, 1, 1), inner, F.slice(segs, -1, 1))).otherwise(segs)


def remove_dot_segments(path: Column, squeeze: Column | bool = False) -> Column:
    """Drop ``.`` segments and let ``..`` remove the segment before it (at the
    root the root's own empty segment; the path begins with a slash all the
    same); a trailing ``.``/``..`` leaves a trailing slash.  With
    ``squeeze``, empty inner segments are dropped first."""
    segs = F.split(path, "/")
    segs = F.when(F.lit(squeeze) if isinstance(squeeze, bool) else squeeze, _squeeze_inner(segs)).otherwise(segs)
    folded = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(
            x == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        )
        .when(x == ".", acc)
        .otherwise(F.array_append(acc, x)),
    )
    last = F.element_at(segs, -1)
    folded = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    return _rooted(F.array_join(folded, "/"))


def _rooted(path: Column) -> Column:
    """A path behind an authority begins with a slash."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def base_of(url: str | Column) -> Column:
    """The directory of a URL: everything up to and including its last '/'."""
    return F.regexp_replace(_col(url), r"[^/]*$", "")


def resolve_url(base: str | Column, href: str | Column) -> Column:
    """Absolute URL of ``href`` as seen from a page at ``base``."""
    base, href = _col(base), _col(href)
    # '//' followed by an empty authority is a path reference: drop the '//'.
    no_auth = href.rlike(r"^//([/?#]|$)")
    href = F.when(no_auth, F.substring(href, 3, 1 << 30)).otherwise(href)
    scheme = F.regexp_extract(base, _SCHEME, 1)
    origin = F.concat(scheme, F.lit("://"), F.regexp_extract(base, _AUTHORITY, 1))
    bpath = F.regexp_extract(base, _PATH, 1)
    bquery = F.regexp_extract(base, _QUERY, 1)
    hpath = F.regexp_extract(href, r"^([^?#]*)", 1)
    hrest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    bdir = F.regexp_replace(bpath, r"[^/]*$", "")
    bdir = F.when(bdir == "", F.lit("/")).otherwise(bdir)
    merged = F.when(hpath.startswith("/"), hpath).otherwise(F.concat(bdir, hpath))
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(~no_auth & href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href == "", F.when(no_auth, F.concat(origin, bpath, bquery)).otherwise(base))
        .when(href.startswith("#"), F.concat(origin, bpath, bquery, href))
        .when(href.startswith("?"), F.concat(origin, bpath, href))
        .otherwise(F.concat(origin, remove_dot_segments(merged, ~hpath.startswith("/")), hrest))
    )


def resolve_url_sql(base: str, href: str) -> str:
    """The same resolution as a DuckDB SQL expression (for the oracle)."""
    no_auth = f"regexp_matches({href}, '^//([/?#]|$)')"
    href = f"(CASE WHEN {no_auth} THEN substr({href}, 3) ELSE {href} END)"
    scheme = f"regexp_extract({base}, '{_SCHEME}', 1)"
    origin = f"({scheme} || '://' || regexp_extract({base}, '{_AUTHORITY}', 1))"
    bpath = f"regexp_extract({base}, '{_PATH}', 1)"
    bquery = f"regexp_extract({base}, '{_QUERY}', 1)"
    hpath = f"regexp_extract({href}, '^([^?#]*)', 1)"
    hrest = f"regexp_extract({href}, '^[^?#]*(.*)$', 1)"
    bdir = f"regexp_replace({bpath}, '[^/]*$', '')"
    bdir = f"(CASE WHEN {bdir} = '' THEN '/' ELSE {bdir} END)"
    merged = f"(CASE WHEN starts_with({hpath}, '/') THEN {hpath} ELSE {bdir} || {hpath} END)"
    raw = f"string_split({merged}, '/')"
    squeezed = (
        f"(CASE WHEN len({raw}) > 2 THEN list_concat(list_concat([{raw}[1]], "
        f"list_filter({raw}[2:len({raw}) - 1], lambda x: x <> '')), [{raw}[len({raw})]]) ELSE {raw} END)"
    )
    segs = f"(CASE WHEN starts_with({hpath}, '/') THEN {raw} ELSE {squeezed} END)"
    fold = (
        f"list_reduce({segs}, lambda acc, x: CASE WHEN x = '..' THEN "
        f"(CASE WHEN len(acc) > 0 THEN acc[:-2] ELSE acc END) WHEN x = '.' THEN acc "
        f"ELSE list_append(acc, x) END, []::VARCHAR[])"
    )
    fold = f"(CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({fold}, '') ELSE {fold} END)"
    joined = f"array_to_string({fold}, '/')"
    path = f"(CASE WHEN starts_with({joined}, '/') THEN {joined} ELSE '/' || {joined} END)"
    return (
        f"(CASE WHEN regexp_matches({href}, '{_SCHEME}') THEN {href} "
        f"WHEN NOT {no_auth} AND starts_with({href}, '//') THEN {scheme} || ':' || {href} "
        f"WHEN {href} = '' THEN (CASE WHEN {no_auth} THEN {origin} || {bpath} || {bquery} ELSE {base} END) "
        f"WHEN starts_with({href}, '#') THEN {origin} || {bpath} || {bquery} || {href} "
        f"WHEN starts_with({href}, '?') THEN {origin} || {bpath} || {href} "
        f"ELSE {origin} || {path} || {hrest} END)"
    )


def with_resolved_url(df, base: str, href: str, out: str):
    """``df`` plus column ``out`` = ``href`` resolved against ``base`` (same
    result as ``resolve_url``).

    The resolution reads each intermediate (normalised reference, its path,
    the merged path, the path segments) several times; as one expression
    every reading would repeat the regular expressions behind it.  Here each
    intermediate is computed once, as a column of a staged projection (Spark
    keeps projections apart rather than duplicate regex work), and the
    helper columns are dropped at the end.
    """
    cols = df.columns
    b, h0 = F.col(base), F.col(href)
    s1 = df.select(
        *cols,
        h0.rlike(r"^//([/?#]|$)").alias("_u_na"),
        F.regexp_extract(b, _SCHEME, 1).alias("_u_scheme"),
        F.regexp_extract(b, _AUTHORITY, 1).alias("_u_auth"),
        F.regexp_extract(b, _PATH, 1).alias("_u_bpath"),
        F.regexp_extract(b, _QUERY, 1).alias("_u_bquery"),
    )
    s2 = s1.select(
        "*",
        F.when(F.col("_u_na"), F.substring(h0, 3, 1 << 30)).otherwise(h0).alias("_u_h"),
        F.regexp_replace("_u_bpath", r"[^/]*$", "").alias("_u_bdir0"),
    )
    h = F.col("_u_h")
    s3 = s2.select(
        "*",
        F.regexp_extract(h, r"^([^?#]*)", 1).alias("_u_hpath"),
        F.regexp_extract(h, r"^[^?#]*(.*)$", 1).alias("_u_hrest"),
        F.concat("_u_scheme", F.lit("://"), "_u_auth").alias("_u_origin"),
    )
    hpath = F.col("_u_hpath")
    bdir = F.when(F.col("_u_bdir0") == "", F.lit("/")).otherwise(F.col("_u_bdir0"))
    s4 = s3.select(
        "*",
        F.split(F.when(hpath.startswith("/"), hpath).otherwise(F.concat(bdir, hpath)), "/").alias("_u_raw"),
    )
    s5 = s4.select(
        "*",
        F.when(hpath.startswith("/"), F.col("_u_raw")).otherwise(_squeeze_inner(F.col("_u_raw"))).alias("_u_segs"),
    )
    segs = F.col("_u_segs")
    s6 = s5.select(
        "*",
        F.aggregate(
            segs,
            F.array().cast("array<string>"),
            lambda acc, x: F.when(x == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
            .when(x == ".", acc)
            .otherwise(F.array_append(acc, x)),
        ).alias("_u_fold"),
    )
    fold = F.when(F.element_at(segs, -1).isin(".", ".."), F.array_append("_u_fold", F.lit(""))).otherwise(
        F.col("_u_fold")
    )
    s7 = s6.select("*", F.array_join(fold, "/").alias("_u_joined"))
    path = _rooted(F.col("_u_joined"))
    origin, bpath, bquery = F.col("_u_origin"), F.col("_u_bpath"), F.col("_u_bquery")
    na = F.col("_u_na")
    resolved = (
        F.when(h.rlike(_SCHEME), h)
        .when(~na & h.startswith("//"), F.concat(F.col("_u_scheme"), F.lit(":"), h))
        .when(h == "", F.when(na, F.concat(origin, bpath, bquery)).otherwise(b))
        .when(h.startswith("#"), F.concat(origin, bpath, bquery, h))
        .when(h.startswith("?"), F.concat(origin, bpath, h))
        .otherwise(F.concat(origin, path, F.col("_u_hrest")))
    )
    return s7.select(*cols, F.when(h0.isNotNull(), resolved).alias(out))
