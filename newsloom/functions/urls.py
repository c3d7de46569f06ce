"""URL columns: parts, joining, validity, tracking marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import any_of, let

# ---- fixed values: hosts that only serve consent or log-in pages ----
BLACKLIST = ("consent.yahoo.com", "guce.yahoo.com", "login.yahoo.com", "consent.google.com")

# ---- fixed value: marks of a tracking, feed or aggregator link ----
TRACKING = r"(utm_|fbclid=|ref=|rss|feedproxy|news.google|amp/?)"

# Scheme, authority, path, query and fragment of a URI reference (RFC 3986, appendix B).
URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def netloc(c: Column) -> Column:
    """Lower-cased authority, port and user info kept; '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(c, r"^(?:[^:/?#]+:)?//([^/?#]*)", 1)), F.lit(""))


def normalized_domain(c: Column) -> Column:
    return F.regexp_replace(netloc(c), r"^www\.", "")


def host(c: Column) -> Column:
    """Authority without user info and port; a URL without a scheme starts with its host."""
    bare = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?([^/?#]*)", 1)
    no_user = F.regexp_replace(F.lower(bare), r"^.*@", "")
    return F.coalesce(F.regexp_replace(F.regexp_replace(no_user, r":\d*$", ""), r"\.+$", ""), F.lit(""))


def registered_domain(c: Column, rules: list[str]) -> Column:
    """Name and public suffix of a URL's host; only the last label where no rule fits.

    A rule is a suffix ("co.uk"), "*.ck" for any one label before "ck", or "!www.ck" for an
    exception to that. The longest suffix wins. '' where there is no host.
    """
    exact = [r for r in rules if r[:2] != "*." and r[:1] != "!"]
    wild = [r[2:] for r in rules if r[:2] == "*."]
    excepted = [r[1:] for r in rules if r[:1] == "!"]

    def named(labels: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(labels))

        def tail(start: Column) -> Column:
            return F.array_join(F.slice(labels, start, F.size(labels)), ".")

        exceptions = F.filter(starts, lambda i: tail(i).isin(*excepted))
        suffixes = F.filter(starts, lambda i: tail(i).isin(*exact) | tail(i + 1).isin(*wild))
        cut = F.coalesce(F.array_min(exceptions) + 1, F.array_min(suffixes))
        name = F.coalesce(F.get(labels, cut - 2), F.lit(""))
        return F.when(cut.isNull(), F.element_at(labels, -1)).otherwise(F.concat_ws(".", name, tail(cut)))

    where = host(c)
    return F.when(where == "", F.lit("")).otherwise(let(F.split(where, r"\."), named))


def is_http_url(c: Column) -> Column:
    return F.coalesce(c.startswith("http"), F.lit(False))


def is_blacklisted(c: Column, domains: tuple[str, ...] = BLACKLIST) -> Column:
    where = netloc(c)
    return any_of([F.contains(where, F.lit(d)) for d in domains])


def looks_tracking(c: Column) -> Column:
    return F.coalesce(c.rlike(f"(?iU){TRACKING}"), F.lit(False))


def choose_original(final: Column, canonical: Column) -> Column:
    """The canonical address if it is a plain web address, else the final one."""
    good = is_http_url(canonical) & ~looks_tracking(canonical)
    return F.when(good, canonical).otherwise(final)


def _uri(c: Column) -> Column:
    part = lambda i: F.regexp_extract(c, f"(?s){URI}", i)
    return F.struct(
        part(1).alias("scheme"),
        part(2).alias("authority"),
        part(3).alias("path"),
        F.when(F.length(part(4)) > 1, part(4)).otherwise("").alias("query"),
        F.when(F.length(part(5)) > 1, part(5)).otherwise("").alias("fragment"),
    )


def _merged_path(path: Column, base_path: Column) -> Column:
    """Path of the reference laid over the base path, dot segments removed.

    Empty segments stay in an absolute path and go where a relative one is merged with its folder.
    """
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    merged = F.regexp_replace(F.concat(folder, path), r"/{2,}", "/")
    full = F.when(path.startswith("/"), path).otherwise(merged)
    segments = F.split(F.substring(full, 2, 1 << 30), "/")

    def step(stack: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", stack)
            .when(segment == "..", F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0))))
            .otherwise(F.concat(stack, F.array(segment)))
        )

    clean = F.aggregate(segments, F.array().cast("array<string>"), step)
    clean = F.when(full.rlike(r"(^|/)\.\.?$"), F.concat(clean, F.array(F.lit("")))).otherwise(clean)
    return F.concat(F.lit("/"), F.array_join(clean, "/"))


def absolutize(href: Column, base: Column) -> Column:
    """`href` resolved against `base`; null for empty `href`."""

    def join(ref: Column) -> Column:
        def over(root: Column) -> Column:
            prefix = F.concat(root["scheme"], F.lit("://"), root["authority"])
            return (
                F.when((ref["scheme"] != "") & (ref["scheme"] != root["scheme"]), href)
                .when(
                    href.startswith("//"),
                    F.concat(root["scheme"], F.lit(":"), href),
                )
                .when(
                    ref["path"] == "",
                    F.concat(
                        prefix,
                        root["path"],
                        F.when(ref["query"] != "", ref["query"]).otherwise(root["query"]),
                        ref["fragment"],
                    ),
                )
                .otherwise(
                    F.concat(
                        prefix, _merged_path(ref["path"], root["path"]), ref["query"], ref["fragment"]
                    )
                )
            )

        return let(_uri(base), over)

    return (
        F.when(href.startswith("http://") | href.startswith("https://"), href)
        .when(href != "", let(_uri(href), join))
    )
