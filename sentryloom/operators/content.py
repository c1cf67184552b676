"""Security content analysis, extraction, page structure and language detection."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import SMALL, small

# Keywords and weights by category, clue patterns, phrases and negative words.
SECURITY = {
    "threat_actors": (0.9, ("apt", "apt28", "apt29", "lazarus", "fin7", "carbanak", "turla", "cozy bear", "fancy bear", "equation group", "darkhydrus", "threat actor", "threat group", "campaign", "operation")),
    "attack_techniques": (0.85, ("phishing", "spear phishing", "malware", "ransomware", "trojan", "backdoor", "rootkit", "exploit", "zero-day", "0-day", "vulnerability", "remote code execution", "rce", "privilege escalation", "lateral movement", "command and control", "c2", "c&c", "exfiltration", "persistence")),
    "security_context": (0.7, ("compromise", "breach", "incident", "attack", "targeted", "victims", "infected", "compromised", "unauthorized", "malicious", "threat", "security", "cyber", "hack", "intrusion", "suspicious")),
    "technical_indicators": (0.8, ("ioc", "indicator", "hash", "domain", "ip address", "registry", "mutex", "yara", "snort", "sigma", "cve", "cvss", "patch", "vulnerability scanner", "payload", "shellcode", "dropper")),
    "security_tools": (0.6, ("firewall", "ids", "ips", "siem", "edr", "antivirus", "av", "sandbox", "honeypot", "forensics", "incident response", "ir", "crowdstrike", "fireeye", "mandiant", "kaspersky", "symantec")),
    "defensive_actions": (0.5, ("mitigation", "remediation", "detection", "prevention", "patch", "update", "fix", "defend", "protect", "secure", "harden", "monitor", "alert", "investigate", "respond", "contain")),
}
CLUES = (
    r"attributed to\s+\w+", r"linked to\s+\w+", r"associated with\s+\w+", r"believed to be\s+\w+",
    r"targeted\s+(?:organizations?|companies|agencies)", r"victims?\s+(?:include|were|are)", r"affected\s+(?:organizations?|systems?|users?)",
    r"exploits?\s+(?:a|the)?\s*(?:vulnerability|bug|flaw)", r"delivers?\s+(?:a|the)?\s*(?:payload|malware|trojan)", r"downloads?\s+(?:additional|second-stage|malicious)", r"executes?\s+(?:code|payload|malware)",
    r"researchers?\s+(?:discovered|found|identified)", r"analysis\s+(?:revealed|showed|found)", r"investigation\s+(?:revealed|uncovered|found)",
    r"(?:ip\s+address|domain|url|hash):\s*\S+", r"[0-9a-fA-F]{32,64}", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", r"[a-zA-Z0-9][a-zA-Z0-9-]{1,61}[a-zA-Z0-9]\.[a-zA-Z]{2,}",
)
PHRASES = ("threat intelligence", "security advisory", "vulnerability disclosure", "incident response", "compromise assessment", "threat hunting", "attack chain", "kill chain", "defense evasion", "initial access", "execution", "persistence", "privilege escalation", "credential access", "discovery", "lateral movement", "command and control", "exfiltration", "impact", "supply chain attack", "watering hole", "drive-by download")
OTHER_SUBJECTS = {
    "business": ("merger", "acquisition", "revenue", "earnings", "stock", "market cap"),
    "product": ("release", "launch", "feature", "update", "version", "roadmap"),
    "api_docs": ("endpoint", "request", "response", "parameter", "authentication", "rate limit"),
    "tutorial": ("how to", "guide", "tutorial", "example", "documentation", "getting started"),
    "marketing": ("announce", "proud", "excited", "available now", "coming soon", "beta"),
}
ACTOR = r"\b(?:APT[0-9]+|FIN[0-9]+|[A-Z][a-z]+\s*(?:Bear|Panda|Tiger|Spider|Kitten))\b"
ENTITIES = {
    "ipv4": (r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", 0.9),
    "domain": (r"\b(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.)+[a-zA-Z]{2,}\b", 0.8),
    "url": (r"https?://[^\s<>\"'`|(){}\[\]\\]+", 0.95),
    "md5": (r"\b[a-fA-F0-9]{32}\b", 0.9),
    "sha1": (r"\b[a-fA-F0-9]{40}\b", 0.9),
    "sha256": (r"\b[a-fA-F0-9]{64}\b", 0.9),
    "cve": (r"(?i)\bCVE-[0-9]{4}-[0-9]{4,}\b", 0.95),
    "email": (r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b", 0.9),
}
#: What a text has to contain for a match of a kind: a cheap linear test, none of whose characters is other than ASCII.
ENTITY_GATES = {
    "ipv4": r"[0-9]\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]",
    "domain": r"[a-zA-Z0-9]\.[a-zA-Z]{2}",
    "url": "http",
    "md5": r"[a-fA-F0-9]{32}",
    "sha1": r"[a-fA-F0-9]{32}",
    "sha256": r"[a-fA-F0-9]{32}",
    "cve": r"-[0-9]{4}-[0-9]{4}",
    "email": "@",
}
FEED_LINKS = (r'<link[^>]*type="application/rss\+xml"[^>]*href="([^"]*)"', r'<link[^>]*type="application/atom\+xml"[^>]*href="([^"]*)"', r'<link[^>]*type="application/json"[^>]*href="([^"]*)"', r'href="([^"]*\.xml)"', r'href="([^"]*feed[^"]*)"', r'href="([^"]*rss[^"]*)"')
FEED_PATHS = ("/rss", "/rss.xml", "/feed", "/feed.xml", "/feeds", "/feeds.xml", "/atom", "/atom.xml", "/blog/feed", "/blog/rss", "/news/feed", "/news/rss", "/index.xml", "/rss2.xml", "/feed.rss", "/articles/feed")
TAXII_PATHS = ("/taxii2/", "/taxii/", "/stix/taxii2/", "/api/taxii2/", "/feeds/taxii2/")

# Columns of page metadata with the attribute and the value that name their meta tag.
META_TAGS = {
    "description": ("name", "description"),
    "keywords": ("name", "keywords"),
    "author": ("name", "author"),
    "published_time": ("property", "article:published_time"),
    "modified_time": ("property", "article:modified_time"),
    "og_title": ("property", "og:title"),
    "og_description": ("property", "og:description"),
    "og_type": ("property", "og:type"),
    "twitter_title": ("name", "twitter:title"),
    "twitter_description": ("name", "twitter:description"),
}

_ASCII = "(?<![A-Za-z0-9_])(?:{})(?![A-Za-z0-9_])"


#: What a text must hold for the clue pattern of the same place to be worth a scan.
CLUE_GATES = ("attributed to", "linked to", "associated with", "believed to be", "targeted", "victim", "affected", "exploit", "deliver", "download", "execute", "researcher", "analysis", "investigation", ":", "[0-9a-f]{32}", r"[0-9]\.[0-9]", r"[a-z0-9]\.[a-z]")
SUBJECTS = {**{c: words for c, (_, words) in SECURITY.items()}, **OTHER_SUBJECTS}


def _alternation(words: set[str]) -> str:
    """All keywords as one pattern, branching on the first letter, longer keywords first."""
    by_letter: dict[str, list[str]] = {}
    for w in sorted(words, key=lambda w: (-len(w), w)):
        by_letter.setdefault(w[0], []).append(re.escape(w[1:]))
    return "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by_letter.items()))


def keyword_matches(text: Column) -> Column:
    """Keywords of all subjects in a text, in lower case, from a single scan.

    Keywords inside a longer one (``phishing`` in ``spear phishing``) are not matched apart;
    ``subject_count`` counts them with it.  No keyword ends as another one begins.
    """
    pattern = "(?i)" + _ASCII.format(_alternation({w for words in SUBJECTS.values() for w in words}))
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda w: F.lower(w))


def subject_count(matches: Column, subjects: tuple[str, ...]) -> Column:
    """Occurrences of each keyword of the subjects, added up, from the matches of a text."""
    words = [w for s in subjects for w in SUBJECTS[s]]
    counts = {m: sum(len(re.findall(rf"(?<!\w){re.escape(w)}(?!\w)", m)) for w in words) for m in {w for ws in SUBJECTS.values() for w in ws}}
    table = F.create_map(*[x for m, n in sorted(counts.items()) if n for x in (F.lit(m), F.lit(n))])
    return F.aggregate(matches, F.lit(0), lambda a, m: a + F.coalesce(F.element_at(table, m), F.lit(0)))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def security_scores(df: DataFrame, text: str, keep_matches: bool = False) -> DataFrame:
    """Adds a score in [0, 1] for each category of keywords, and ``security``, their mean."""
    df = df.withColumns({"_words": F.greatest(F.lit(1.0), word_count(F.col(text)) / 100), "_kw": keyword_matches(F.col(text))})
    df = df.withColumns({c: F.least(F.lit(1.0), subject_count(F.col("_kw"), (c,)) / F.col("_words") * w) for c, (w, _) in SECURITY.items()})
    total = sum((F.col(c) for c in list(SECURITY)[1:]), F.col(next(iter(SECURITY))))
    return df.withColumn("security", total / len(SECURITY)).drop("_words", *([] if keep_matches else ["_kw"]))


def context_clues(text: Column) -> Column:
    """Distinct phrases of more than 5 characters (cut at 100) that speak for security content, the first 10."""
    low = F.lower(text)
    gate = lambda g: low.rlike(g) if re.search(r"[\[\\]", g) else F.contains(low, F.lit(g))
    found = F.flatten(F.array(*[F.when(gate(g), F.regexp_extract_all(low, F.lit(f"(?i){p}"), F.lit(0))).otherwise(F.array().cast("array<string>")) for p, g in zip(CLUES, CLUE_GATES, strict=True)]))
    return F.slice(F.array_distinct(F.filter(F.transform(found, lambda x: F.left(F.trim(x), F.lit(100))), lambda x: F.length(x) > 5)), 1, 10)


def analyze_content(df: DataFrame, text: str) -> DataFrame:
    """Adds scores, clues, ``confidence``, ``content_type``, ``depth`` and the enrichment ``route``."""
    df = security_scores(df, text, True).withColumn("clues", context_clues(F.col(text)))
    t = F.col(text)
    low = F.lower(t)
    phrases = sum((F.contains(low, F.lit(p)).cast("int") for p in PHRASES[1:]), F.contains(low, F.lit(PHRASES[0])).cast("int"))
    words = F.greatest(F.lit(1.0), word_count(t) / 50)
    df = df.withColumns({"_other": F.least(F.lit(1.0), subject_count(F.col("_kw"), tuple(OTHER_SUBJECTS)) / words), "_api": subject_count(F.col("_kw"), ("api_docs",)), "_phrases": phrases})
    df = df.withColumns({"_cve": t.rlike(r"(?i)CVE-[0-9]{4}-[0-9]{4,7}"), "_actor": t.rlike(ACTOR), "_mark": t.rlike(ENTITIES["ipv4"][0]) | t.rlike(r"\b(?:[a-fA-F0-9]{32}|[a-fA-F0-9]{40}|[a-fA-F0-9]{64})\b")})
    entity = F.least(F.lit(0.3), F.when(F.col("_cve"), 0.15).otherwise(0.0) + F.when(F.col("_actor"), 0.15).otherwise(0.0) + F.when(F.col("_mark"), 0.1).otherwise(0.0))
    confidence = 0.3 * F.col("security") + F.least(F.lit(0.25), 0.05 * F.size("clues")) + F.least(F.lit(0.15), 0.03 * F.col("_phrases")) + entity - 0.5 * F.col("_other")
    # In whole millionths: what lies on a threshold but for the noise of doubles reaches it.
    df = df.withColumn("confidence", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), confidence)) + 1e-9, 6))
    c, named = F.col("confidence"), F.col("_cve") | F.col("_actor")
    kind = (
        F.when(c >= 0.7, "security_threat")
        .when(c >= 0.4, F.when(named, "security_advisory").when(F.col("security_tools") > 0.5, "security_tools").otherwise("potential_security"))
        .when(c >= 0.2, F.when(F.col("_other") > 0.5, "mixed_content").otherwise("unclear"))
        .when(F.col("_other") > 0.6, F.when(F.col("_api") > 0, "api_documentation").otherwise("business_content"))
        .otherwise("general_content")
    )
    depth = F.when((c >= 0.7) & ((F.size("clues") >= 5) | named | F.col("_mark")), "comprehensive").when((c >= 0.4) | (F.size("clues") >= 3), "detailed").otherwise("basic")
    k = F.col("content_type")
    route = F.when(k.isin("security_threat", "security_advisory", "potential_security"), "advanced").when(k.isin("api_documentation", "security_tools"), "technical").when(k.isin("mixed_content", "unclear"), "hybrid").otherwise("basic")
    return df.withColumn("content_type", kind).withColumns({"depth": depth, "route": route}).drop("_kw", "_other", "_api", "_phrases", "_cve", "_actor", "_mark")


def top_indicators(df: DataFrame, key: str, k: int = 3) -> DataFrame:
    """The highest-scoring categories of each row, those of score zero left out."""
    each = df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("score")) for c in SECURITY])).alias("_s")).select(key, "_s.*").filter("score > 0")
    return each.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "category"))).filter(F.col("rank") <= k)


def entity_text(text: Column, kind: str) -> Column:
    r"""The text in which matches of a kind are looked for: other than ASCII characters as a sign that is part of no word.

    Regex engines differ in whether ``\b`` takes such a character for part of a word; patterns
    with ``\b`` match ASCII characters only, so values and positions are those of the text.
    """
    return F.regexp_replace(text, r"[^\x00-\x7F]", "¤") if r"\b" in ENTITIES[kind][0] else text


def extract_entities(df: DataFrame, text: str, kinds: tuple[str, ...] = tuple(ENTITIES)) -> DataFrame:
    """One row for each match: ``kind, value, confidence`` (hashes in lower, CVE ids in upper case).

    A text is searched for a kind only if it passes the kind's gate; gates and the text of
    ``entity_text`` are made once for all kinds.
    """
    t, gates = F.col(text), sorted({ENTITY_GATES[k] for k in kinds})
    passes = F.array(*[t.rlike(g) if re.search(r"[\[\\]", g) else F.contains(t, F.lit(g)) for g in gates])
    out = df.select("*", passes.alias("_entity_gates"))
    bounded = [F.col("_entity_gates")[gates.index(ENTITY_GATES[k])] for k in kinds if r"\b" in ENTITIES[k][0]]
    out = out.withColumn("_entity_text", F.when(reduce(or_, bounded, F.lit(False)), entity_text(t, "ipv4")))
    found = []
    for kind in kinds:
        pattern, confidence = ENTITIES[kind]
        case = F.lower if kind in ("md5", "sha1", "sha256") else F.upper if kind == "cve" else lambda v: v
        values = F.regexp_extract_all(F.col("_entity_text") if r"\b" in pattern else t, F.lit(pattern), F.lit(0))
        values = F.when(F.col("_entity_gates")[gates.index(ENTITY_GATES[kind])], values).otherwise(F.array().cast("array<string>"))
        found.append(F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), case(v).alias("value"), F.lit(confidence).alias("confidence"))))  # noqa: B023
    return out.withColumn("_e", F.explode(F.flatten(F.array(*found)))).select(*df.columns, "_e.*")


def entity_spans(df: DataFrame, text: str, kinds: tuple[str, ...] = tuple(ENTITIES), around: int = 20) -> DataFrame:
    """The rows of ``extract_entities`` with ``char_start``, ``char_end`` (after the last character) and ``context``, the characters around.

    Positions count characters from 0.  One linear pass in Arrow batches, as built-in functions
    give no positions of all matches; in the text of ``entity_text``, where both engines take
    the same for words, so the rows are the same on any text.  Null text gives no rows.
    """
    compiled = [(k, re.compile(ENTITIES[k][0], re.ASCII), ENTITIES[k][1], r"\b" in ENTITIES[k][0]) for k in kinds]
    case = {"md5": str.lower, "sha1": str.lower, "sha256": str.lower, "cve": str.upper}
    other = re.compile(r"[^\x00-\x7F]")

    @F.pandas_udf("array<struct<kind string, value string, confidence double, char_start int, char_end int, context string>>")
    def spans(texts: pd.Series) -> pd.Series:
        def of(t: str | None) -> list[dict]:
            plain = other.sub("¤", t or "")
            return [
                {"kind": k, "value": case.get(k, str)(m.group()), "confidence": c, "char_start": m.start(), "char_end": m.end(), "context": t[max(0, m.start() - around) : m.end() + around]}
                for k, p, c, bounded in compiled
                for m in p.finditer(plain if bounded else t or "")
            ]

        return texts.map(of)

    return df.withColumn("_e", F.explode(spans(F.col(text)))).select(*df.columns, "_e.*")


class _Sections(HTMLParser):
    """Headings, paragraphs, list items and quotes of a page in order, with its title; menus (``nav``) have none."""

    MENUS = ("nav",)

    KINDS = {**{f"h{i}": ("headline", i) for i in range(1, 7)}, "p": ("paragraph", 0), "li": ("list", 0), "blockquote": ("quote", 0)}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, int, str, bool]] = []
        self.title, self.open, self.skip, self.article, self.menu, self.text = "", None, 0, 0, 0, []

    def close_block(self) -> None:
        if self.open:
            text = " ".join("".join(self.text).split())
            if text:
                self.rows.append((*self.open, text, self.article > 0))
        self.open, self.text = None, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.skip += 1
        elif tag in self.MENUS:
            self.close_block()
            self.menu += 1
        elif tag == "article":
            self.article += 1
        elif self.menu:
            return
        elif tag == "title":
            self.close_block()
            self.open = ("title", 0)
        elif tag in self.KINDS:
            self.close_block()
            self.open = self.KINDS[tag]

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in self.MENUS:
            self.menu = max(0, self.menu - 1)
        elif tag == "title" and self.open == ("title", 0):
            self.title, self.open, self.text = " ".join("".join(self.text).split()), None, []
        elif tag in self.KINDS and self.open == self.KINDS[tag]:
            self.close_block()
        elif tag == "article":
            self.close_block()
            self.article = max(0, self.article - 1)

    def handle_data(self, data: str) -> None:
        if self.open and not self.skip:
            self.text.append(data)


#: Characters of markup whose sections go back to Spark together.
CHUNK_CHARS = 4 << 20


def parse_pages(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Section rows of pages in one pass: ``position, kind, level, content, in_article`` and the page's ``title``."""

    names = [key, "title", "position", "kind", "level", "content", "in_article"]
    kinds = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.bool_())

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out, chars = [], [], 0
            for page in range(batch.num_rows):
                text = batch.column(1)[page].as_py() or ""
                parser = _Sections()
                parser.feed(text)
                parser.close()
                parser.close_block()
                at += [page] * len(parser.rows)
                out += [(parser.title, i, *row) for i, row in enumerate(parser.rows)]
                chars += len(text)
                # Sections go back in pieces, so that no task holds those of a whole batch.
                if chars >= CHUNK_CHARS or page == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]], names=names)
                    at, out, chars = [], [], 0

    return df.select(key, html).mapInArrow(parse, T.StructType([T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL("title string, position int, kind string, level int, content string, in_article boolean").fields]))


def _attribute(tag: Column, name: str) -> Column:
    """The value of a quoted or bare attribute of a tag; null if it is absent or empty."""
    found = [F.nullif(F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*{value}", 1), F.lit("")) for value in ('"([^"]*)"', "'([^']*)'", "([^\\s\"'>]+)")]
    return F.coalesce(*found)


def _inner_text(markup: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(markup, "<[^>]*>", " "), r"[ \t\n\r\f\x0B]+", " "))


def page_metadata(df: DataFrame, html: str = "html", headings: int = 10, images: int = 10) -> DataFrame:
    """Adds what a page says of itself: ``title`` (first heading if there is none), meta tags, ``canonical_url``, ``language``, the first headings and images.

    Attributes may stand in any order and either quotes; what is absent or empty is null.
    """
    h = F.col(html)
    tags = lambda name: F.regexp_extract_all(h, F.lit(rf"(?is)<{name}\s[^>]*>"), F.lit(0))
    first = lambda found: F.try_element_at(found, F.lit(1))
    heads = F.regexp_extract_all(h, F.lit(r"(?is)<h[1-6][^>]*>.*?</h[1-6]>"), F.lit(0))
    heads = F.transform(heads, lambda x: F.struct(F.substring(x, 3, 1).cast("int").alias("level"), _inner_text(x).alias("text")))
    pictures = F.filter(F.transform(tags("img"), lambda t: F.struct(_attribute(t, "src").alias("src"), _attribute(t, "alt").alias("alt"))), lambda t: t["src"].isNotNull())
    df = df.withColumns({"_meta": tags("meta"), "_heads": heads})
    metas = {c: _attribute(first(F.filter("_meta", lambda t: _attribute(t, a) == v)), "content") for c, (a, v) in META_TAGS.items()}  # noqa: B023
    title = F.nullif(_inner_text(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))
    canonical = _attribute(first(F.filter(tags("link"), lambda t: _attribute(t, "rel") == "canonical")), "href")
    out = df.withColumns({"title": F.coalesce(title, first("_heads")["text"]), **metas, "canonical_url": canonical, "language": _attribute(first(tags("html")), "lang")})
    return out.withColumns({"headings": F.slice("_heads", 1, headings), "images": F.slice(pictures, 1, images)}).drop("_meta", "_heads")


def page_links(df: DataFrame, html: str = "html", base: str = "url") -> DataFrame:
    """One row for each link with an address: ``position, link_url`` (made absolute), ``link_text`` and ``is_external`` (its host is not the page's).

    Dot segments of relative paths stay as they are; addresses without a host (``mailto:``) are external.
    """
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*>.*?</a>"), F.lit(0))
    rows = df.select("*", F.posexplode(anchors).alias("position", "_a"))
    rows = rows.withColumn("_h", _attribute(F.regexp_extract("_a", r"(?s)^<[^>]*>", 0), "href")).filter("_h IS NOT NULL")
    part = lambda pattern: F.regexp_extract(base, pattern, 0)
    root = part("^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*")
    folder = part("^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/(?:[^?#]*/)?")
    front = (
        F.when(F.col("_h").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), "")
        .when(F.col("_h").startswith("//"), part("^[A-Za-z][A-Za-z0-9+.-]*:"))
        .when(F.col("_h").startswith("/"), root)
        .when(F.col("_h").startswith("?"), part("^[^?#]*"))
        .when(F.col("_h").startswith("#"), part("^[^#]*"))
        .otherwise(F.when(folder == "", F.concat(root, F.lit("/"))).otherwise(folder))
    )
    host = lambda c: F.lower(F.regexp_extract(c, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = rows.withColumns({"link_url": F.concat(front, "_h"), "link_text": _inner_text(F.col("_a"))})
    return rows.withColumn("is_external", host(F.col("link_url")) != host(F.col(base))).drop("_a", "_h")


def article_text(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The main text of a page: ``text, paragraphs, words, confidence`` and the ``method`` that gave it.

    Paragraphs are looked for in the first ``article``, in the first ``main`` and in the whole
    page; each attempt has a confidence from its length, its paragraphs and the article tag, and
    the best one (of equals the first) stays.  Where no attempt finds a paragraph the text is all
    of the page without scripts and styles (method ``all``, confidence 0.1).
    """
    inside = lambda tag: F.regexp_extract(F.coalesce(html, F.lit("")), rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
    blank = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"[ \t\n\r\f\x0B]+", " "))
    out = df.select(key, F.coalesce(html, F.lit("")).alias("_h"), inside("article").alias("_article"), inside("main").alias("_main"))
    attempts = []
    for rank, (method, body, bonus) in enumerate((("article", F.col("_article"), 0.2), ("main", F.col("_main"), 0.0), ("page", F.col("_h"), 0.0))):
        paras = F.filter(F.transform(F.regexp_extract_all(body, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1)), blank), lambda p: F.length(p) > 0)
        out = out.withColumn(f"_p{rank}", paras).withColumn(f"_t{rank}", F.array_join(f"_p{rank}", "\n\n"))
        n, words = F.size(f"_p{rank}"), word_count(F.col(f"_t{rank}"))
        score = 0.5 - F.when(words < 50, 0.2).otherwise(0.0) - F.when(n < 3, 0.1).otherwise(0.0) - F.when(words / F.greatest(n, F.lit(1)) < 10, 0.1).otherwise(0.0) + bonus
        attempts.append(F.when(n > 0, F.struct(F.round(F.greatest(F.lit(0.1), F.least(F.lit(0.9), score)), 6).alias("confidence"), F.lit(-rank).alias("rank"), F.lit(method).alias("method"), F.col(f"_t{rank}").alias("text"), n.alias("paragraphs"), words.alias("words"))))
    everything = blank(F.regexp_replace("_h", r"(?is)<(script|style)(?:\s[^>]*)?>.*?</(script|style)>", " "))
    last = F.struct(F.lit(0.1).alias("confidence"), F.lit(-9).alias("rank"), F.lit("all").alias("method"), everything.alias("text"), F.lit(0).alias("paragraphs"), word_count(everything).alias("words"))
    best = F.coalesce(F.array_max(F.array_compact(F.array(*attempts))), last)
    return out.select(key, best.alias("_b")).select(key, "_b.text", "_b.paragraphs", "_b.words", "_b.confidence", "_b.method")


def page_outline(sections: DataFrame, key: str = "page_id") -> DataFrame:
    """Each section under the latest headline before it."""
    w = Window.partitionBy(key).orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return sections.withColumn("under", F.last(F.when(F.col("kind") == "headline", F.col("content")), ignorenulls=True).over(w))


def page_stats(sections: DataFrame, key: str = "page_id") -> DataFrame:
    """Sections and words by page, counts of kinds, the content density, and ``points`` with their ``band``.

    Points: 30 for a headline, 10 for each kind, 20 for more than 100 words and 20 more for
    more than 500, 20 for a list or quote.
    """
    k = F.col("kind")
    kinds = ("headline", "paragraph", "list", "quote")
    out = sections.groupBy(key).agg(F.count(F.lit(1)).alias("sections"), F.sum(word_count(F.col("content"))).alias("words"), *[F.count_if(k == x).alias(f"n_{x}") for x in kinds], F.size(F.collect_set("kind")).alias("_kinds"))
    out = out.withColumn("density", (0.3 * F.col("n_headline") + 0.4 * F.col("n_paragraph") + 0.2 * F.col("n_list") + 0.1 * F.col("n_quote")) / F.col("sections"))
    give = lambda holds, n: F.when(holds, n).otherwise(0)
    points = give(F.col("n_headline") > 0, 30) + 10 * F.col("_kinds") + give(F.col("words") > 100, 20) + give(F.col("words") > 500, 20) + give(F.col("n_list") + F.col("n_quote") > 0, 20)
    out = out.withColumn("points", points).drop("_kinds")
    p = F.col("points")
    return out.withColumn("band", F.when(p >= 80, "excellent").when(p >= 60, "good").when(p >= 40, "fair").otherwise("poor"))


def page_topics(sections: DataFrame, most: int = 10, key: str = "page_id", phrase_words: int = 3) -> DataFrame:
    """The headlines of each page, and the ``emphasised`` phrases of at most three words if sections have them, in lower case, each once, the first ones in page order: ``topic, rank``."""
    found = F.when(F.col("kind") == "headline", F.array("content")).otherwise(F.array().cast("array<string>"))
    if "emphasised" in sections.columns:
        found = F.concat(found, F.filter("emphasised", lambda e: word_count(e) <= phrase_words))
    each = sections.select(key, "position", F.posexplode(found).alias("_i", "_t"))
    first = each.groupBy(key, F.lower("_t").alias("topic")).agg(F.min(F.struct("position", "_i")).alias("_at"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("_at"))).filter(F.col("rank") <= most).drop("_at")


def section_context(sections: DataFrame, n: int = 2, key: str = "page_id") -> DataFrame:
    """Adds the contents of the n sections before and after."""
    w = Window.partitionBy(key).orderBy("position")
    return sections.withColumns({"before": F.collect_list("content").over(w.rowsBetween(-n, -1)), "after": F.collect_list("content").over(w.rowsBetween(1, n))})


def find_feed_links(df: DataFrame, html: str, base: str) -> DataFrame:
    """Absolute URLs of the feeds that a page links to, once each."""
    found = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(F.col(html), F.lit(f"(?i){p}"), F.lit(1)) for p in FEED_LINKS])))
    root = F.regexp_extract(base, "^([a-z]+://[^/?#]*)", 1)
    rows = df.withColumn("_l", F.explode(found))
    link = F.when(F.col("_l").rlike("^[a-z]+://"), F.col("_l")).when(F.col("_l").startswith("/"), F.concat(root, "_l")).otherwise(F.concat(root, F.lit("/"), "_l"))
    return rows.withColumn("feed_url", link).drop("_l").distinct()


def discover_feed_candidates(sites: DataFrame, url: str) -> DataFrame:
    """Every usual feed and TAXII address of each site, with the way it was found."""
    paths = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(m).alias("method"), F.lit(c).alias("confidence")) for m, c, ps in (("common_paths", 0.7, FEED_PATHS), ("taxii_discovery", 0.9, TAXII_PATHS)) for p in ps])
    root = F.regexp_extract(url, "^([a-z]+://[^/?#]*)", 1)
    return sites.select(root.alias("site")).distinct().withColumn("_p", F.explode(paths)).select("site", F.concat("site", "_p.path").alias("feed_url"), "_p.method", "_p.confidence")


def attention_normalize(df: DataFrame, key: str, phrase: str, weight: str, most: int = 10) -> DataFrame:
    """The strongest phrases of each key with weights divided by the largest; a missing weight is 0.5."""
    w = F.coalesce(F.col(weight), F.lit(0.5))
    rows = df.select(key, phrase, w.alias("_w")).withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_w"), phrase))).filter(F.col("rank") <= most)
    return rows.withColumn("attention", F.col("_w") / F.max("_w").over(Window.partitionBy(key))).drop("_w")


def trigrams(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row for each lower-case character trigram of each row, repeats included."""
    low = F.lower(F.col(text))
    # Neighbouring trigrams overlap, so three scans that start one character apart find them all.
    grams = F.concat(*[F.regexp_extract_all(F.substr(low, F.lit(i)), F.lit("(?s)..."), F.lit(0)) for i in (1, 2, 3)])
    return df.filter((F.length(text) >= 3) & (F.length(F.lower(text)) >= 3)).select(*keep, F.explode(grams).alias("gram"))


#: Characters of texts that are looked at together.
SLICE_CHARS = 1 << 20


def _gram_slices(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Trigrams as numbers, 21 bits a character, and the number of each one's text; a long text comes in slices that overlap by two."""
    part: list[str] = []
    owners: list[int] = []
    size = 0

    def made() -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.repeat(np.arange(len(part)), [len(x) for x in part])
        inside = ends[:-2] == ends[2:]
        return (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[inside], np.array(owners)[ends[:-2][inside]]

    for number, text in enumerate(texts):
        for at in range(0, len(text or "") - 2, SLICE_CHARS):
            part.append(text[at : at + SLICE_CHARS + 2])
            owners.append(number)
            size += len(part[-1])
            if size >= SLICE_CHARS:
                yield made()
                part, owners, size = [], [], 0
    if part:
        yield made()


def _gram_text(codes: np.ndarray) -> list[str]:
    return np.stack([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF], axis=1).astype(np.uint32).view("<U3").ravel().tolist() if len(codes) else []


def fit_language(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Smoothed log-probabilities of trigrams by language, as a table; rows without a language are not learned from.

    Trigrams are counted where texts are read, a batch at a time, so few rows are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, number = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
            for codes, owner in _gram_slices(batch.column(1).to_pylist()):
                order = np.argsort(number[owner], kind="stable")
                bounds = np.searchsorted(number[owner][order], np.arange(len(names) + 1))
                for name, low, high in zip(names, bounds[:-1], bounds[1:], strict=True):
                    if low < high:
                        grams, n = np.unique(codes[order[low:high]], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(_gram_text(grams), pa.string()), pa.array(n.astype(np.int64))], names=[lang, "gram", "n"])

    rows = df.filter(F.col(lang).isNotNull() & (F.length(text) >= 3)).select(F.col(lang).cast("string").alias(lang), F.lower(text).alias("_t"))
    counts = rows.mapInArrow(count, T.StructType([T.StructField(lang, T.StringType()), *T.StructType.fromDDL("gram string, n long").fields])).groupBy(lang, "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(lang).agg(F.sum("n").alias("total"))
    return counts.join(totals, lang).select(lang, "gram", F.log((F.col("n") + 1) / (F.col("total") + 100_000)).alias("logp"), F.log(1 / (F.col("total") + 100_000)).alias("floor"))


def _detect_here(df: DataFrame, model: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """``key, detected`` by a model that every task holds as one matrix, trigrams by languages."""
    rows = model.select(F.col(lang).cast("string").alias("lang"), "gram", (F.col("logp") - F.col("floor")).alias("gain"), "floor").toArrow().to_pandas()
    names = sorted(rows["lang"].unique())
    codes = np.array([ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]) for g in rows["gram"]], np.int64)
    known, at = np.unique(codes, return_inverse=True)
    gains = np.full((len(known), len(names)), np.nan)
    gains[at, np.searchsorted(names, rows["lang"].to_numpy(str)) if len(names) else []] = rows["gain"]
    floors = np.array([rows["floor"][rows["lang"] == x].iloc[0] for x in names])
    shared = df.sparkSession.sparkContext.broadcast((known, gains, floors, names))

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gains, floors, names = shared.value
        seen, gains = ~np.isnan(gains), np.nan_to_num(gains)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            score, met = np.zeros((len(texts), len(names))), np.zeros((len(texts), len(names)))
            for found, owner in _gram_slices(texts) if len(known) else ():
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                hit = known[place] == found
                place, owner = place[hit], owner[hit]
                for k in range(len(names)):
                    score[:, k] += np.bincount(owner, gains[place, k], len(texts))
                    met[:, k] += np.bincount(owner, seen[place, k], len(texts))
            score += np.array([max(0, len(t or "") - 2) for t in texts])[:, None] * floors
            score[met == 0] = -np.inf
            best = len(names) - 1 - score[:, ::-1].argmax(axis=1) if names else np.zeros(len(texts), int)  # of equal scores the last name
            said = [names[b] if m else "unknown" for b, m in zip(best, met.any(axis=1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=[key, "detected"])

    return df.select(key, F.lower(text).alias("_t")).mapInArrow(detect, T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("detected", T.StringType())]))


def detect_language(df: DataFrame, model: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """The likeliest language of each row; ``unknown`` where no trigram is known.

    ``model`` should be a written table: up to ``SMALL`` rows of it go to every task as one
    matrix, and texts are scored where they are read; a larger one meets the counted trigrams
    of each row in a shuffle.
    """
    if model.limit(SMALL + 1).count() <= SMALL:
        return _detect_here(df, model, key, text, lang)
    # logp - floor of known trigrams plus the floor for all of them: absent (language, trigram) rows need no join.
    side = model.select(lang, "gram", (F.col("logp") - F.col("floor")).alias("_gain"))
    met = trigrams(df, text, key).groupBy(key, "gram").agg(F.count(F.lit(1)).alias("_k")).join(side, "gram")
    scores = met.groupBy(key, lang).agg(F.sum(F.col("_k") * F.col("_gain")).alias("gain"))
    totals = df.groupBy(key).agg(F.sum(F.greatest(F.length(F.lower(F.col(text))) - 2, F.lit(0))).alias("_n"))
    floors = model.groupBy(lang).agg(F.first("floor").alias("_floor"))
    full = scores.join(totals, key).join(small(floors), lang).withColumn("score", F.col("gain") + F.col("_n") * F.col("_floor"))
    best = full.groupBy(key).agg(F.max_by(lang, F.struct("score", lang)).alias("detected"))
    return df.select(key).join(best, key, "left").withColumn("detected", F.coalesce("detected", F.lit("unknown")))
