"""Payload parsers: JSON, feeds, IOC lists, STIX bundles and scan events to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_url

#: The canonical record of the collection stages.
RECORD = "id string, url string, title string, description string, source_name string, source_type string, tags array<string>, published_at string"
_ATTRIBUTE = "struct<value:string,type:string,category:string,comment:string,timestamp:string,to_ids:boolean,Tag:array<struct<name:string>>>"


def decode_json_lenient(text: Column) -> Column:
    """A VARIANT from JSON, or from a literal with single quotes; null if neither."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.replace(text, F.lit("'"), F.lit('"'))))


def parse_feed_xml(df: DataFrame, xml: str) -> DataFrame:
    """One row an entry of RSS or Atom documents: ``feed_title, entry_id, title, link, published, content, categories``.

    The id is the entry's id, guid, link, or the MD5 of title and time.  An Atom entry's link is
    its first one to the page itself (``alternate`` or no relation), else its first.
    """
    rss = F.from_xml(xml, "channel STRUCT<title STRING, item ARRAY<STRUCT<guid STRING, title STRING, link STRING, pubDate STRING, description STRING, author STRING, category ARRAY<STRING>>>>", {"rowTag": "rss"})
    atom = F.from_xml(xml, "title STRING, entry ARRAY<STRUCT<id STRING, title STRING, link ARRAY<STRUCT<_VALUE STRING, _href STRING, _rel STRING>>, published STRING, updated STRING, summary STRING, content STRING>>", {"rowTag": "feed"})
    is_atom = F.col(xml).rlike("(?s)^\\s*(<\\?xml[^>]*>\\s*)?<feed")
    keep = [c for c in df.columns if c != xml]
    none = F.lit(None).cast("string")
    a = df.filter(~is_atom).select(*keep, rss.alias("_f")).select(*keep, F.col("_f.channel.title").alias("feed_title"), F.explode("_f.channel.item").alias("_e"))
    a = a.select(*keep, "feed_title", none.alias("_id"), F.col("_e.guid").alias("_guid"), F.col("_e.title").alias("title"), F.col("_e.link").alias("link"), F.col("_e.pubDate").alias("published"), F.col("_e.description").alias("content"), F.coalesce("_e.category", F.array().cast("array<string>")).alias("categories"))
    links = F.filter("_e.link", lambda x: F.length(x["_href"]) > 0)
    page = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(page, F.lit(0))["_href"], F.get(links, F.lit(0))["_href"])
    b = df.filter(is_atom).select(*keep, atom.alias("_f")).select(*keep, F.col("_f.title").alias("feed_title"), F.explode("_f.entry").alias("_e"))
    b = b.select(*keep, "feed_title", F.col("_e.id").alias("_id"), none.alias("_guid"), F.col("_e.title").alias("title"), link.alias("link"), F.coalesce("_e.published", "_e.updated").alias("published"), F.coalesce("_e.content", "_e.summary").alias("content"), F.array().cast("array<string>").alias("categories"))
    rows = a.unionByName(b)
    entry = F.coalesce("_id", "_guid", "link", F.md5(F.concat_ws("", "title", "published")))
    return rows.withColumn("entry_id", entry).drop("_id", "_guid")


def parse_ioc_json(df: DataFrame, col: str) -> DataFrame:
    """Indicator rows of MISP JSON: a list, ``response``, ``Attribute`` (one or many) or a single object."""
    doc = F.try_parse_json(F.col(col))
    many = lambda path: F.try_variant_get(doc, path, f"array<{_ATTRIBUTE}>")
    one = lambda path: F.try_variant_get(doc, path, _ATTRIBUTE)
    items = F.coalesce(many("$"), many("$.response"), many("$.Attribute"), F.when(one("$.Attribute").isNotNull(), F.array(one("$.Attribute"))), F.when(one("$").isNotNull(), F.array(one("$"))))
    keep = [c for c in df.columns if c != col]
    rows = df.select(*keep, F.explode(items).alias("_i")).select(*keep, "_i.*")
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return rows.select(*keep, "value", F.coalesce("type", F.lit("unknown")).alias("type"), text("category"), text("comment"), "timestamp", F.coalesce("to_ids", F.lit(False)).alias("to_ids"), F.coalesce(F.transform("Tag", lambda t: t["name"]), F.array().cast("array<string>")).alias("tags")).filter(F.length("value") > 0)


def parse_ioc_csv(df: DataFrame, col: str) -> DataFrame:
    """``value,type[,comment]`` lines; blank lines, comments and lines of one field are passed over."""
    keep = [c for c in df.columns if c != col]
    lines = df.select(*keep, F.explode(F.split(col, "\r?\n")).alias("_l")).filter((F.trim("_l") != "") & ~F.trim("_l").startswith("#"))
    parts = F.transform(F.split("_l", ","), lambda x: F.trim(x))
    return lines.withColumn("_p", parts).filter(F.size("_p") >= 2).select(*keep, F.get("_p", F.lit(0)).alias("value"), F.get("_p", F.lit(1)).alias("type"), F.coalesce(F.get("_p", F.lit(2)), F.lit("")).alias("comment"))


def parse_feed_by_format(df: DataFrame, fmt: str, col: str) -> DataFrame:
    """csv with a header, json, misp-json, or else one row a line that is not blank, as maps of text."""
    keep = [c for c in df.columns if c not in (fmt, col)]
    lines = df.filter(F.col(fmt) == "csv").withColumn("_l", F.filter(F.split(col, "\r?\n"), lambda x: F.trim(x) != ""))
    heads = F.split(F.get("_l", F.lit(0)), ",")
    csv = lines.select(*keep, heads.alias("_h"), F.explode(F.slice("_l", F.lit(2), F.size("_l"))).alias("_r")).select(*keep, F.map_from_arrays("_h", F.slice(F.split("_r", ","), F.lit(1), F.size("_h"))).alias("item"))
    js = df.filter(F.col(fmt).isin("json", "misp-json"))
    doc = F.try_parse_json(F.col(col))
    kind = "map<string,string>"
    items = F.coalesce(F.try_variant_get(doc, "$", f"array<{kind}>"), F.try_variant_get(doc, "$.response", f"array<{kind}>"), F.array(F.try_variant_get(doc, "$", kind)))
    js = js.select(*keep, F.explode(items).alias("item"))
    raw = df.filter(~F.col(fmt).isin("csv", "json", "misp-json")).select(*keep, F.explode(F.split(col, "\r?\n")).alias("_l")).filter(F.trim("_l") != "").select(*keep, F.create_map(F.lit("raw"), F.trim("_l")).alias("item"))
    return csv.unionByName(js).unionByName(raw)


def explode_stix_bundle(df: DataFrame, col: str) -> DataFrame:
    """One row an object of a STIX bundle; confidence is 50 unless given."""
    shape = "array<struct<id:string,type:string,name:string,spec_version:string,created:string,modified:string,labels:array<string>,confidence:int,description:string,external_references:array<struct<url:string>>>>"
    items = F.try_variant_get(F.try_parse_json(F.col(col)), "$.objects", shape)
    keep = [c for c in df.columns if c != col]
    rows = df.select(*keep, F.explode(items).alias("_o")).select(*keep, "_o.*")
    return rows.withColumn("confidence", F.coalesce("confidence", F.lit(50))).withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


def _record(**columns: Column) -> list[Column]:
    kinds = {c.split()[0]: c.split()[1] for c in RECORD.split(", ")}
    return [columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()]


def stix_to_records(df: DataFrame, host: str, collection: str) -> DataFrame:
    """Records of STIX objects: the first external URL or a TAXII address; name, else id as title; modified, else created as time."""
    url = F.coalesce(F.get("external_references.url", F.lit(0)), F.concat(F.lit(f"taxii://{host}/{collection}/"), "id"))
    return df.select(*_record(id=F.col("id"), url=url, title=F.coalesce("name", "id"), description=F.col("description"), source_name=F.lit(host), source_type=F.lit("taxii"), tags=F.col("labels"), published_at=F.coalesce("modified", "created")))


def ioc_to_records(df: DataFrame, feed: str) -> DataFrame:
    """Records of indicators: the comment, or type and value as title."""
    title = F.coalesce(F.nullif(F.col("comment"), F.lit("")), F.concat("type", F.lit(": "), "value"))
    note = F.concat(F.when(F.col("to_ids"), F.lit("Actionable indicator ")).otherwise("Indicator "), "value")
    return df.select(*_record(id=F.md5(F.concat("type", "value")), url=F.concat(F.lit(f"misp://{feed}/"), "value"), title=title, description=note, source_name=F.lit(feed), source_type=F.lit("misp"), tags=F.col("tags"), published_at=F.col("timestamp")))


def scan_event_to_records(df: DataFrame) -> DataFrame:
    """Records of scan events ``ip, port, hostnames, product, devicetype, banner, vulns, tags, timestamp``."""
    host = F.coalesce(F.get("hostnames", F.lit(0)), F.col("ip"))
    scheme = F.when(F.col("port").isin(443, 8443), "https://").otherwise("http://")
    url = F.concat(scheme, host, F.when(F.col("port").isin(80, 443), "").otherwise(F.concat(F.lit(":"), "port")))
    named = F.nullif(F.concat_ws(" | ", F.nullif("devicetype", F.lit("")), F.nullif("product", F.lit(""))), F.lit(""))
    line = F.nullif(F.left(F.split("banner", "\n")[0], F.lit(50)), F.lit(""))
    title = F.coalesce(named, line, F.concat(F.lit("Event for "), "ip", F.lit(":"), "port"))
    return df.select(*_record(id=F.md5(F.concat("ip", F.lit(":"), "port", "timestamp")), url=url, title=title, description=F.col("banner"), source_name=F.lit("scan"), source_type=F.lit("scan"), tags=F.array_union("tags", F.coalesce(F.map_keys("vulns"), F.array().cast("array<string>"))), published_at=F.col("timestamp")))


def feed_entry_to_records(df: DataFrame, feed_url: str) -> DataFrame:
    """Records of feed entries; entries without a link go, the feed's host is the source."""
    rows = df.filter(F.length("link") > 0)
    return rows.select(*_record(id=F.col("entry_id"), url=F.col("link"), title=F.col("title"), description=F.col("content"), source_name=F.try_parse_url(F.col(feed_url), F.lit("HOST")), source_type=F.lit("rss"), tags=F.col("categories"), published_at=F.col("published")))


def seed_feeds(*lists: DataFrame) -> DataFrame:
    """Seed lists with ``url`` and maybe ``name``, as one list of normalised URLs, each once (the first name in order)."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists).withColumn("url", normalize_url(F.trim("url"))).filter(F.col("url").rlike(r"^https?://[^/?#]+\.[^/?#]+"))
    return rows.groupBy("url").agg(F.min("name").alias("name"))


def read_topic(spark: SparkSession, source: str, schema: str, stream: bool = True, fmt: str = "json", **options: str) -> DataFrame:
    """JSON messages of topics or files as columns; what does not parse is kept in ``_corrupt_record``.

    ``fmt='kafka'`` subscribes to the comma-separated topics in ``source`` from the earliest
    offset (this needs the connector's jar, which the test box lacks); other formats read
    files in the folder ``source``.
    """
    full = f"{schema}, _corrupt_record STRING"
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        raw = reader.format("kafka").option("subscribe", source).option("startingOffsets", "earliest").options(**options).load()
        value = F.from_json(F.col("value").cast("string"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        return raw.select("key", "topic", "partition", "offset", "timestamp", value.alias("m")).select("key", "topic", "partition", "offset", "timestamp", "m.*")
    return reader.format(fmt).schema(full).option("mode", "PERMISSIVE").options(**options).load(source)


def write_topic(df: DataFrame, topic: str, key: Column) -> DataFrame:
    """Rows as messages: ``topic, key, value`` (JSON), ready for a Kafka or file sink."""
    return df.select(F.lit(topic).alias("topic"), key.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def export_link_health(df: DataFrame, path: str, fmt: str = "json", status: str | None = None) -> None:
    (df.filter(F.col("status") == status) if status else df).write.mode("overwrite").option("header", "true").format(fmt).save(path)


def import_link_health(spark: SparkSession, path: str, schema: str, existing: DataFrame, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """Rows to add, and one row of counts: imported, skipped (known URL) and errors (unreadable)."""
    rows = spark.read.schema(f"{schema}, _corrupt_record STRING").option("mode", "PERMISSIVE").option("header", "true").format(fmt).load(path)
    known = existing.select("url").distinct().withColumn("_k", F.lit(True))
    marked = rows.join(known, "url", "left")
    bad = F.col("url").isNull() | F.col("_corrupt_record").isNotNull()
    counts = marked.agg(F.count_if(~bad & F.col("_k").isNull()).alias("imported"), F.count_if(~bad & F.col("_k").isNotNull()).alias("skipped"), F.count_if(bad).alias("errors"))
    return marked.filter(~bad & F.col("_k").isNull()).drop("_k", "_corrupt_record"), counts
