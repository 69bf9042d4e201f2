"""Hosts, URLs and domains as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_www(host: Column) -> Column:
    """Lower case, no dots at the ends, one leading `www.` less."""
    return F.regexp_replace(F.regexp_replace(F.lower(host), r"^\.+|\.+$", ""), r"^www\.", "")


def normalize_host(host: Column) -> Column:
    """'' for null, empty, or a host that holds @; the port is cut."""
    clean = F.regexp_replace(F.lower(F.trim(F.coalesce(host, F.lit("")))), r"^\.+|\.+$", "")
    return F.when(clean.contains("@"), "").otherwise(strip_www(F.split_part(clean, F.lit(":"), F.lit(1))))


def domain_from_url(url: Column) -> Column:
    """Normalized host; a missing scheme is taken as https."""
    full = F.when(url.contains("://"), url).otherwise(F.concat(F.lit("https://"), url))
    place = F.regexp_extract(full, r"://([^/?#]*)", 1)
    return F.when(F.coalesce(url, F.lit("")) == "", "").otherwise(normalize_host(F.regexp_replace(place, "^.*@", "")))


def normalize_domain(raw: Column) -> Column:
    """Host of messy input: scheme, path, user and port are cut; '' unless only a-z, 0-9, dots and hyphens are left."""
    s = F.trim(F.coalesce(raw, F.lit("")))
    s = F.when(s.contains("://"), F.regexp_replace(s, "^.*?://", "")).otherwise(s)
    s = F.regexp_replace(s, r"[/?#].*$", "")
    s = F.regexp_replace(s, "^.*@", "")
    s = strip_www(F.regexp_replace(s, r":[0-9]+$", ""))
    return F.when(s.rlike(r"^[a-z0-9.\-]+$"), s).otherwise("")


def _encoded(x: Column) -> Column:
    """Percent-encoding anew: decoded where that can be done, blanks as +, ~ kept, * encoded."""
    plain = F.coalesce(F.try_url_decode(x), F.regexp_replace(x, r"\+", " "))
    return F.replace(F.replace(F.url_encode(plain), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _query(query: Column) -> Column:
    """Pairs of a query, sorted; a blank value keeps its =, empty pairs go."""
    pairs = F.filter(F.split(query, "&"), lambda x: x != "")
    made = F.transform(pairs, lambda x: F.struct(_encoded(F.regexp_extract(x, "^([^=]*)", 1)).alias("k"), _encoded(F.regexp_extract(x, "^[^=]*=?(.*)$", 1)).alias("v")))
    return F.array_join(F.transform(F.array_sort(made), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")


def _without_dots(path: Column) -> Column:
    """Path with . and .. segments resolved; a final one leaves a slash."""
    parts = F.split(F.regexp_replace(path, r"(^|/)(\.\.?)$", "$1$2/"), "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda a, x: F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.concat(a, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolve(ref: Column, base: Column) -> Column:
    """A reference seen from a page: with a scheme as it is; from //, /, ? or a relative path by the page's URL."""
    root, path = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1), F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    own, rest = F.regexp_extract(ref, r"^([^?#]*)", 1), F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    joined = F.when(own == "", path).when(own.startswith("/"), _without_dots(own)).otherwise(_without_dots(F.concat(F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", ""), own)))
    return F.when(ref.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:") | ref.startswith("//"), ref).otherwise(F.concat(root, joined, rest))


def normalize_url(url: Column, base: Column | None = None) -> Column:
    """http(s) URL in normal form, else null; relative ones need a base. The scheme is https for port 443 or without a port if it was https."""
    u = F.regexp_replace(url, r"^\s+|\s+$", "")
    refused = (F.coalesce(u, F.lit("")) == "") | u.startswith("#") | u.startswith("javascript:") | u.startswith("mailto:")
    u = F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u)
    if base is not None:
        u = resolve(u, base)
    scheme, place = F.lower(F.regexp_extract(u, r"^([a-zA-Z]+)://", 1)), F.regexp_replace(F.regexp_extract(u, r"^[a-zA-Z]+://([^/?#]*)", 1), "^.*@", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[a-zA-Z]+://[^/?#]*([^?#]*)", 1), ";[^/]*$", "")
    pairs = _query(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1))
    host, port = normalize_host(F.regexp_replace(place, r"^\[([^\]]*)\].*$", "$1")), F.regexp_extract(place, r":([0-9]+)$", 1)  # of an address in brackets what stands before its first colon
    https = (port == "443") | ((port == "") & (scheme == "https"))
    out = F.concat(
        F.when(https, "https://").otherwise("http://"),
        host,
        F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)),
        F.when(path == "", "/").otherwise(path),
        F.when(pairs == "", "").otherwise(F.concat(F.lit("?"), pairs)),
    )
    return F.when(refused | ~scheme.isin("http", "https") | (host == ""), None).otherwise(out)


def suffixes(host: Column) -> Column:
    """The host and every tail after a dot: turns dot-suffix matches into equi-joins."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def brand_fold(brand: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(brand, F.lit(""))), "[^a-z0-9]+", "")


def brand_slug(brand: Column) -> Column:
    return F.substring(brand_fold(brand), 1, 48)


def embedded_domain(brand: Column) -> Column:
    """First host-like token of a brand, else ''."""
    found = F.regexp_extract_all(F.lower(brand), F.lit(r"\b((?:[a-z0-9][a-z0-9-]*\.)+[a-z]{2,63})\b"), 1)
    return F.coalesce(F.get(F.filter(F.transform(found, normalize_domain), lambda x: x != ""), F.lit(0)), F.lit(""))


def _distinct(n: int, *hosts: Column) -> Column:
    return F.slice(F.array_distinct(F.filter(F.array(*hosts), lambda x: x.isNotNull() & (x != ""))), 1, n)


def guess_hosts(brand: Column, n: int = 4) -> Column:
    slug = brand_slug(brand)
    to = lambda tail, head="": F.when(slug != "", F.concat(F.lit(head), slug, F.lit(tail)))
    return _distinct(n, embedded_domain(brand), to(".com"), to(".net"), F.when(F.lower(brand).contains("casino") & ~slug.endswith("casino"), to("casino.com")), to(".com", "play"))


def membrane_hosts(brand: Column, terms: list[str], n: int = 6) -> Column:
    """Guesses over the slug and its winz / wins variant, four endings each, then two for brands of an operator's kind."""
    slug = brand_slug(brand)
    other = F.when(slug.contains("winz"), F.regexp_replace(slug, "^(.*?)winz", "$1wins")).when(slug.contains("wins") & ~slug.contains("casino"), F.regexp_replace(slug, "^(.*?)wins", "$1winz"))
    ends = [F.concat(s, F.lit(t)) for s in (F.when(slug != "", slug), other) for t in (".com", ".net", ".org", ".us")]
    kind = F.exists(F.array(*map(F.lit, terms)), lambda t: F.lower(brand).contains(t)) & (slug != "")
    return _distinct(n, embedded_domain(brand), *ends, F.when(kind & ~slug.endswith("casino"), F.concat(slug, F.lit("casino.com"))), F.when(kind, F.concat(slug, F.lit("sweeps.com"))))


def hashed_id(prefix: str, n: int, *parts: Column) -> Column:
    """prefix and n hexadecimal digits of the SHA-256 of the parts, joined by U+241F; nulls as ''."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("␟", *(F.coalesce(p, F.lit("")) for p in parts)), 256), 1, n))


def redirect_target(primary: Column, final_url: Column, status: Column) -> Column:
    """The final URL, if the status says so or its host is another than the primary one; else ''."""
    host = domain_from_url(final_url)
    other = (host != "") & (normalize_host(primary) != "") & (host != normalize_host(primary))
    return F.when(F.coalesce(final_url, F.lit("")) == "", "").when((status == "redirected") | other, F.substring(final_url, 1, 500)).otherwise("")


def resembles_brand(brand: Column, final_url: Column) -> Column:
    """1 if the final host without its dots holds the first ten letters of a brand of four or more."""
    slug = brand_slug(brand)
    return F.when((F.length(slug) >= 4) & F.replace(domain_from_url(F.coalesce(final_url, F.lit(""))), F.lit("."), F.lit("")).contains(F.substring(slug, 1, 10)), 1).otherwise(0)


def entity_id(domain: Column) -> Column:
    return F.concat(F.lit("candidate_"), F.replace(domain, F.lit("."), F.lit("_")))


def job_id(brand: Column, source: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.coalesce(brand, F.lit("")), F.lit("|"), F.coalesce(source, F.lit(""))), 256), 1, 16)
