"""Column functions: URLs, markup, tags, times, indicators and text checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the checks look for.
TRACKING_PARAMETERS = ("fbclid", "gclid")
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"))
INDICATOR_TYPES = {
    "ip": "ipv4", "ip_address": "ipv4", "ipaddr": "ipv4", "domain": "domain", "hostname": "domain", "fqdn": "domain", "url": "url", "uri": "url",
    "hash": "hash", "md5": "md5", "sha1": "sha1", "sha256": "sha256", "sha512": "sha512", "email": "email", "email_address": "email",
    "filename": "filename", "file": "filename", "registry_key": "registry_key", "mutex": "mutex", "user_agent": "user_agent",
}
PAYWALL = ("subscribe to read", "premium content", "members only", "paid subscribers", "unlock full article", "paywall")
VENDORS = ("Microsoft", "Google", "Amazon", "Apple", "Cisco", "Palo Alto", "FireEye", "CrowdStrike", "Symantec")
CTI_KEYWORDS = ("security", "threat", "vulnerability", "malware", "cyber", "attack", "breach", "incident", "advisory", "alert", "intelligence", "ioc", "indicator", "stix", "taxii", "apt", "campaign", "phishing")
# Time patterns with the shape of the text that each one reads.
_DAY, _CLOCK = r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[0-9]{2}:[0-9]{2}:[0-9]{2}"
TIME_PATTERNS = {
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX": rf"^{_DAY}T{_CLOCK}\.[0-9]{{6}}(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$",
    "yyyy-MM-dd'T'HH:mm:ss.SSSX": rf"^{_DAY}T{_CLOCK}\.[0-9]{{3}}(Z|[+-][0-9]{{2}}(:?[0-9]{{2}})?)$",
    "yyyy-MM-dd'T'HH:mm:ssX": rf"^{_DAY}T{_CLOCK}(Z|[+-][0-9]{{2}})$",
    "yyyy-MM-dd HH:mm:ssxx": rf"^{_DAY} {_CLOCK}[+-][0-9]{{4}}$",
    "yyyy-MM-dd HH:mm:ss": rf"^{_DAY} {_CLOCK}$",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS": rf"^{_DAY}T{_CLOCK}\.[0-9]{{6}}$",
    "yyyy-MM-dd'T'HH:mm:ss": rf"^{_DAY}T{_CLOCK}$",
    "dd MMM yyyy HH:mm:ss z": rf"^[0-9]{{2}} [A-Z][a-z]{{2}} [0-9]{{4}} {_CLOCK} [A-Z]+$",
    "dd MMM yyyy HH:mm:ss xx": rf"^[0-9]{{2}} [A-Z][a-z]{{2}} [0-9]{{4}} {_CLOCK} [+-][0-9]{{4}}$",
    "yyyy-MM-dd": rf"^{_DAY}$",
}
HASH_LENGTHS = {"md5": 32, "sha1": 40, "sha256": 64, "sha512": 128}

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_H = "[0-9A-Fa-f]{1,4}"
IPV6 = "^(" + "|".join([rf"({_H}:){{7}}{_H}", rf"({_H}:){{1,7}}:"] + [rf"({_H}:){{1,{7 - n}}}(:{_H}){{1,{n}}}" for n in range(1, 7)] + [rf":((:{_H}){{1,7}}|:)"]) + ")$"
_LABEL = "[a-zA-Z0-9]([a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
DOMAIN = rf"^{_LABEL}(\.{_LABEL})*$"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _has(col: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(F.lower(col), F.lit(w.lower())) for w in words])


def normalize_url(url: Column) -> Column:
    """Scheme added, host in lower case, tracking parameters, blank values and the fragment dropped; null if empty."""
    full = F.when(url.rlike("^(https?|ftp)://"), url).otherwise(F.concat(F.lit("https://"), url))
    head = F.regexp_extract(full, r"^([A-Za-z]+://)", 1)
    rest = F.regexp_replace(F.substr(full, F.length(head) + 1), "#.*$", "")
    host, path, query = F.regexp_extract(rest, r"^([^/?]*)", 1), F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=.") & ~p.rlike("^(utm_|(" + "|".join(TRACKING_PARAMETERS) + ")=)"))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.length(url) > 0, F.concat(head, F.lower(host), path, tail))


def crawl_key(url: Column) -> Column:
    """scheme://host/path?query with the host in lower case, without fragment or path parameters."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r";[^/?]*", "")
    return F.concat(F.regexp_extract(bare, r"^([^:]+://)", 1), F.lower(F.regexp_extract(bare, r"^[^:]+://([^/?]*)", 1)), F.regexp_extract(bare, r"^[^:]+://[^/?]*(.*)$", 1))


def url_domain(url: Column) -> Column:
    """Host and port of a URL, ``unknown`` if there is none."""
    return F.coalesce(F.nullif(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")), F.lit("unknown"))


def clean_text(text: Column) -> Column:
    """Tags dropped, white space collapsed, five entities decoded; null becomes empty."""
    out = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", ""), r"[ \t\n\r\f\x0B]+", " "))
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, out)


def clean_html(html: Column, most: int = 500_000) -> Column:
    """Script and style blocks dropped, tags to spaces, white space collapsed, cut at ``most`` characters."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "")
    return F.left(F.trim(F.regexp_replace(F.regexp_replace(out, "<[^>]+>", " "), r"[ \t\n\r\f\x0B]+", " ")), F.lit(most))


def normalize_tags(tags: Column) -> Column:
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(F.filter(tags, lambda t: t.isNotNull()), lambda t: F.lower(F.trim(t))))), F.array().cast("array<string>"))


def normalize_timestamp(value: Column, now: Column) -> Column:
    """ISO-8601 seconds in UTC: numbers are epoch seconds (above 1e12 milliseconds), text has one of the known patterns.

    Empty gives ``now``; what cannot be read stays as it is.  A weekday in front is ignored.
    """
    number = value.try_cast("double")
    seconds = F.when(number > 1e12, number / 1000).otherwise(number)
    text = F.regexp_replace(value, r"^[A-Za-z]{3}, ", "")
    parsed = F.coalesce(*[F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(p))) for p, shape in TIME_PATTERNS.items()])
    time = F.when(number.isNotNull(), F.timestamp_seconds(F.floor(seconds))).otherwise(parsed)
    iso = F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return F.when(F.coalesce(F.length(value), F.lit(0)) == 0, now).otherwise(F.coalesce(iso, value))


def normalize_indicator_type(kind: Column) -> Column:
    """Lower case with underscores, then the usual name; unknown types pass."""
    name = F.translate(F.lower(kind), "- ", "__")
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in INDICATOR_TYPES.items() for x in pair]), name), name)


def is_valid_indicator(value: Column, kind: Column) -> Column:
    """Whether a value has the form of its (normalised) type; other types need a non-blank value."""
    hashes = reduce(lambda a, t: a.when(kind == t, value.rlike(f"^[a-fA-F0-9]{{{HASH_LENGTHS[t]}}}$")), HASH_LENGTHS, F.when(kind == "ipv4", value.rlike(IPV4)))
    rule = hashes.when(kind == "ipv6", value.rlike(IPV6)).when(kind == "domain", (F.length(value) <= 253) & value.rlike(DOMAIN)).when(kind == "email", value.rlike(EMAIL))
    rule = rule.when(kind == "url", value.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+")).otherwise(F.length(F.trim(value)) > 0)
    return F.when((F.length(value) > 0) & (F.length(kind) > 0), rule).otherwise(False)


def _filled(col: Column) -> Column:
    return F.coalesce(F.length(col) > 0, F.lit(False))


def _points(*parts: tuple[Column, float]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(c, F.lit(p)).otherwise(0.0) for c, p in parts])


def indicator_confidence(to_ids: Column, category: Column, comment: Column) -> Column:
    return F.least(F.lit(1.0), F.lit(0.5) + _points((to_ids, 0.3), (_filled(category), 0.1), (_filled(comment), 0.1)))


def content_quality(title: Column, content: Column, summary: Column, published: Column, author: Column, tags: Column) -> Column:
    text = F.length(F.coalesce(F.nullif(content, F.lit("")), summary, F.lit("")))
    score = _points((_filled(title), 0.2), (_filled(content) | _filled(summary), 0.3), (published.isNotNull(), 0.1), (_filled(author), 0.1), (F.coalesce(F.size(tags) > 0, F.lit(False)), 0.1))
    return F.least(F.lit(1.0), score + F.when(text > 100, 0.2).when(text > 50, 0.1).otherwise(0.0))


def indicator_quality(value: Column, kind: Column, context: Column, location: Column, confidence: Column) -> Column:
    return F.least(F.lit(1.0), F.lit(0.5) + _points((is_valid_indicator(value, kind), 0.3), (_filled(context), 0.1), (_filled(location), 0.05), (F.coalesce(confidence > 0.8, F.lit(False)), 0.15)))


def _quoted(col: Column) -> Column:
    """A JSON string of plain text: quotes, backslashes and the usual control characters escaped."""
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
        col = F.replace(col, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), col, F.lit('"'))


def content_hash(title: Column, link: Column, published: Column, content: Column) -> Column:
    """SHA-256 of the non-empty fields as JSON with sorted keys."""
    fields = [("content", content), ("link", link), ("published", published), ("title", title)]
    parts = F.array_compact(F.array(*[F.when(_filled(c), F.concat(F.lit(f'"{k}": '), _quoted(c))) for k, c in fields]))
    return F.sha2(F.concat(F.lit("{"), F.array_join(parts, ", "), F.lit("}")), 256)


def indicator_hash(value: Column, kind: Column) -> Column:
    """MD5 of the trimmed lower-case type and value as JSON with sorted keys."""
    low = lambda c: _quoted(F.trim(F.lower(F.coalesce(c, F.lit("")))))
    return F.md5(F.concat(F.lit('{"type": '), low(kind), F.lit(', "value": '), low(value), F.lit("}")))


def classify_page(title: Column) -> Column:
    return F.when(_has(title, ("login", "sign in")), "login_page").when(_has(title, ("error", "not found")), "error_page").otherwise("article")


def detect_paywall(text: Column) -> Column:
    return _has(text, PAYWALL)


def first_vendor(text: Column) -> Column:
    return F.coalesce(*[F.when(F.contains(F.lower(text), F.lit(v.lower())), F.lit(v)) for v in VENDORS])


def quality_band(score: Column) -> Column:
    return F.when(score >= 0.8, "excellent").when(score >= 0.6, "good").when(score >= 0.4, "fair").when(score >= 0.2, "poor").otherwise("very_poor")


def select_text(*candidates: Column) -> Column:
    """The first text that is not empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def bucket_ioc(value: Column) -> Column:
    """The kind of an indicator string by ordered rules; null if none fits."""
    v = F.trim(value)
    dots = F.contains(v, F.lit("."))
    return (
        F.when(v.startswith("CVE-"), "cve")
        .when(F.contains(v, F.lit("@")) & dots, "email")
        .when(v.rlike("^https?://"), "url")
        .when(v.rlike(r"^[0-9]+(\.[0-9]+)+$"), "ip")
        .when(dots & ~F.contains(v, F.lit("/")), "domain")
        .when(v.rlike("^([0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64}|[0-9a-fA-F]{128})$"), "hash")
        .when(_has(v, ("apt", "group", "actor")), "threat_actor")
    )


def cti_relevant(title: Column, description: Column, content: Column) -> Column:
    """A keyword in title or description, or two different ones in the content."""
    found = [F.contains(F.lower(F.coalesce(content, F.lit(""))), F.lit(k)).cast("int") for k in CTI_KEYWORDS]
    return _has(F.concat_ws(" ", title, description), CTI_KEYWORDS) | (reduce(lambda a, b: a + b, found) >= 2)


def needs_enrichment(title: Column, description: Column, content: Column) -> Column:
    short = lambda c, n: c.isNull() | (F.length(c) < n)
    return _filled(content) & (short(title, 20) | short(description, 50))


def fetchable(content_type: Column, length: Column, allowed: tuple[str, ...] = ("text/html", "application/xhtml+xml", "text/plain", "application/xml")) -> Column:
    """An allowed content type and a length from 100 bytes to 10 MB."""
    kinds = reduce(lambda a, b: a | b, [F.contains(F.lower(content_type), F.lit(k)) for k in allowed])
    return kinds & length.between(100, 10 * 1024 * 1024)


def redact(text: Column) -> Column:
    """Values with a password or API key are replaced; long ones are cut for export."""
    secret = _has(text, ("password", "api_key"))
    return F.when(secret, "***redacted***").when(F.length(text) > 1000, F.concat(F.left(text, F.lit(500)), F.lit("...[truncated]"))).otherwise(text)


def render_template(template: str, **columns: Column) -> Column:
    """``{name}`` replaced by columns; null counts as empty."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(columns[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def detect_feed_kind(content: Column, url: Column) -> Column:
    """rss, atom, json or taxii by leading markup, JSON keys, then the URL."""
    low, link = F.lower(F.trim(content)), F.lower(url)
    xml = low.rlike("^<(\\?xml|rss|feed)")
    doc = F.try_parse_json(content)
    has = lambda path: F.try_variant_get(doc, path, "string").isNotNull()
    by_url = reduce(lambda a, k: a.when(F.contains(link, F.lit(k)), k), ("atom", "json", "taxii"), F.when(F.contains(link, F.lit("rss")), "rss"))
    return F.when(xml & F.contains(low, F.lit("<rss")), "rss").when(xml & F.contains(low, F.lit("<feed")) & F.contains(low, F.lit('xmlns="http://www.w3.org/2005/atom"')), "atom").when(has("$.version") & has("$.items"), "json").when(has("$.api_roots"), "taxii").otherwise(by_url)


def detect_payload_kind(payload: Column, url: Column) -> Column:
    """The kind of a JSON payload by its structure, then by the URL that it came from."""
    doc, link = F.try_parse_json(payload), F.lower(F.coalesce(url, F.lit("")))
    get = lambda path: F.try_variant_get(doc, path, "string")
    feed = F.when(get("$.items").isNotNull(), F.lower(get("$.feed_info.type")))
    return (
        F.when((get("$.type") == "bundle") & get("$.objects").isNotNull(), "stix_bundle")
        .when(get("$.indicators").isNotNull() | get("$.Attribute").isNotNull(), "misp_feed")
        .when(F.contains(feed, F.lit("rss")), "rss_feed").when(F.contains(feed, F.lit("atom")), "atom_feed")
        .when(_filled(get("$.version")) & get("$.items").isNotNull(), "json_feed")
        .when(F.contains(link, F.lit("taxii")), "taxii_content").when(link.rlike("rss|feed\\.xml"), "rss_feed").when(F.contains(link, F.lit("atom")), "atom_feed")
        .otherwise("unknown")
    )


def feed_quality(confidence: Column, title: Column, description: Column, language: Column, method: Column, content: Column) -> Column:
    """A discovered feed's score from its metadata, how it was found and its content."""
    weights = {"html_links": 0.2, "common_paths": 0.15, "taxii_discovery": 0.3, "json_feed": 0.1, "html_patterns": 0.05}
    by_method = reduce(lambda a, m: a.when(method == m, weights[m]), list(weights)[1:], F.when(method == "html_links", 0.2)).otherwise(0.0)
    times = lambda tag: (F.length(content) - F.length(F.replace(content, F.lit(tag), F.lit("")))) / len(tag)
    items = F.coalesce(times("<item>") + times("<entry>"), F.lit(0.0))
    dated = F.coalesce(F.contains(content, F.lit("pubDate")) | F.contains(content, F.lit("updated")), F.lit(False))
    score = confidence + _points((_filled(title), 0.1), (_filled(description), 0.1), (_filled(language), 0.05), (dated, 0.1)) + by_method + F.when(items > 10, 0.1).when(items > 5, 0.05).otherwise(0.0)
    return F.least(F.lit(1.0), score)
