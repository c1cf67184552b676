"""Raw payloads to normalised items, and from raw intelligence to graph tables and dead letters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hooks import enrich_with
from ..functions.text import clean_text, detect_payload_kind, indicator_confidence, is_valid_indicator, normalize_indicator_type, normalize_timestamp
from ..tables import written
from .content import ENTITIES, entity_text
from .graph import intel_to_changeset, iocs_to_changeset, stix_to_changeset
from .relations import enrich_geo

_ENTRY = "array<struct<id:string,guid:string,title:string,content:string,summary:string,link:string,published:string,updated:string,author:string,categories:array<string>>>"
_INDICATOR = "array<struct<value:string,type:string,category:string,comment:string,timestamp:string,to_ids:boolean>>"
_OBJECT = "array<struct<id:string,type:string,name:string,spec_version:string,created:string,modified:string,labels:array<string>,confidence:int,source_ref:string,target_ref:string,relationship_type:string>>"
#: Kinds of entities that become nodes, by the names that the graph gives them.
NODE_KINDS = {"ip": ("ipv4",), "domain": ("domain",), "url": ("url",), "cve": ("cve",), "email": ("email",), "hash": ("md5", "sha1", "sha256")}
#: Where the items of a kind of payload stand.
ITEM_PATHS = {"rss_feed": "$.items", "atom_feed": "$.items", "misp_feed": "$.indicators", "stix_bundle": "$.objects"}


def _none() -> Column:
    return F.array().cast("array<string>")


def normalize_payload(df: DataFrame, kind: str, payload: str, now: Column) -> DataFrame:
    """The valid items of JSON payloads of one kind, one row each, beside the other columns.

    ``rss_feed`` and ``atom_feed``: ``id`` (or guid, or link), cleaned texts, link, times, author,
    categories.  ``misp_feed``: indicators with a trimmed value, the usual type name, time and
    confidence; invalid ones go.  ``stix_bundle``: objects (with an id and a type) with times;
    confidence 50 unless given.  Any other kind gives the payload itself as ``content``, marked generic.  Payloads
    that are no JSON or lack the items give no rows; null fields become empty texts.
    """
    keep = [F.col(c) for c in df.columns if c != payload]
    doc = F.try_parse_json(F.col(payload))
    return _items(df, kind, payload, now, keep, doc).filter("error IS NULL").drop("error")


def _items(df: DataFrame, kind: str, payload: str, now: Column, keep: list[Column], doc: Column) -> DataFrame:
    """The items of payloads, good or not, with what is wrong as ``error``."""
    rows = lambda path, shape: df.select(*keep, F.explode(F.try_variant_get(doc, path, shape)).alias("_i"))
    i = lambda c: F.col(f"_i.{c}")
    if kind in ("rss_feed", "atom_feed"):
        some = lambda c: F.nullif(i(c), F.lit(""))
        texts = [clean_text(i(c)).alias(c) for c in ("title", "content", "summary")]
        times = [normalize_timestamp(i(c), now).alias(c) for c in ("published", "updated")]
        return rows("$.items", _ENTRY).select(*keep, F.coalesce(some("id"), some("guid"), i("link")).alias("id"), *texts, i("link").alias("link"), *times, i("author").alias("author"), F.coalesce(i("categories"), _none()).alias("categories"), F.lit("rss_item" if kind == "rss_feed" else "atom_entry").alias("source_type"), F.when(F.col("_i").isNull(), "no item").alias("error"))
    if kind == "misp_feed":
        flag, text = F.coalesce(i("to_ids"), F.lit(False)), lambda c: F.coalesce(i(c), F.lit(""))
        out = rows("$.indicators", _INDICATOR).select(*keep, F.trim(text("value")).alias("value"), normalize_indicator_type(text("type")).alias("type"), text("category").alias("category"), text("comment").alias("comment"), normalize_timestamp(i("timestamp"), now).alias("timestamp"), flag.alias("to_ids"), indicator_confidence(flag, text("category"), text("comment")).alias("confidence"), F.lit("misp_indicator").alias("source_type"))
        return out.withColumn("error", F.when(~is_valid_indicator(F.col("value"), F.col("type")), "invalid indicator"))
    if kind == "stix_bundle":
        plain = [i(c).alias(c) for c in ("id", "type", "name", "spec_version", "source_ref", "target_ref", "relationship_type")]
        times = [normalize_timestamp(i(c), now).alias(c) for c in ("created", "modified")]
        return rows("$.objects", _OBJECT).select(*keep, *plain, *times, F.coalesce(i("labels"), _none()).alias("labels"), F.coalesce(i("confidence"), F.lit(50)).alias("confidence"), F.lit("stix_object").alias("source_type"), F.when(~F.coalesce((F.length(i("id")) > 0) & (F.length(i("type")) > 0), F.lit(False)), "no id or type").alias("error"))
    return df.filter(doc.isNotNull()).select(*keep, F.col(payload).alias("content"), F.lit("generic").alias("source_type"), now.alias("normalized_at"), F.lit(None).cast("string").alias("error"))


def enriched_to_graph(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``source_url, retrieved_at, full_text, indicators`` (value, type) ``, geo_locations`` (ip, country) -> nodes ``id, label, text`` and edges, each once.

    A node is named by its label and key; an article is made only where there is text, and an
    address is placed in its country only if it is a node of the batch.
    """
    c = F.col
    name = lambda label, *keys: F.concat_ws(":", F.lit(label), *keys)
    source, event, article = name("source", c("source_url")), name("event", c("retrieved_at")), name("article", c("source_url"))
    each = df.select(event.alias("_e"), F.explode("indicators").alias("_i")).select("_e", name("indicator", c("_i.type"), c("_i.value")).alias("_n"), c("_i.value").alias("text"))
    places = df.select(F.explode("geo_locations").alias("_g")).select(name("indicator", F.lit("ipv4"), c("_g.ip")).alias("source_id"), c("_g.country").alias("country")).filter("country IS NOT NULL").distinct()
    text = F.length("full_text") > 0
    node = lambda frame, id_, label, value, when=None: (frame if when is None else frame.filter(when)).select(id_.alias("id"), F.lit(label).alias("label"), value.alias("text"))
    edge = lambda frame, a, b, kind, when=None: (frame if when is None else frame.filter(when)).select(a.alias("source_id"), b.alias("target_id"), F.lit(kind).alias("type"))
    nodes = [node(df, source, "Source", c("source_url")), node(df, event, "SightingEvent", c("retrieved_at")), node(df, article, "Article", c("full_text"), text), node(each, c("_n"), "Indicator", c("text")), node(places, name("country", c("country")), "Country", c("country"))]
    all_nodes = reduce(DataFrame.unionByName, nodes).groupBy("id", "label").agg(F.max("text").alias("text"))
    located = places.join(each.select(c("_n").alias("source_id")).distinct(), "source_id", "left_semi")
    edges = [edge(df, event, source, "REPORTED_BY"), edge(df, article, event, "ABOUT", text), edge(each, c("_n"), c("_e"), "APPEARED_IN"), edge(located, c("source_id"), name("country", c("country")), "LOCATED_IN")]
    return all_nodes, reduce(DataFrame.unionByName, edges).distinct()


class Ingested(NamedTuple):
    nodes: DataFrame
    edges: DataFrame
    dead: DataFrame
    account: DataFrame


def one_node_each(nodes: DataFrame) -> DataFrame:
    """One row a node: of a property with several values the largest; properties of all rows together."""
    each = nodes.select("id", "label", F.explode_outer("properties").alias("k", "v")).withColumn("k", F.when(F.col("v").isNotNull(), F.col("k")))
    last = each.groupBy("id", "label", "k").agg(F.max("v").alias("v"))
    return last.groupBy("id", "label").agg(F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "v"))))).alias("properties"))


def resolve_relations(relations: DataFrame, nodes: DataFrame) -> DataFrame:
    """STIX relations (``source_ref, target_ref`` and more) with ``source_id, target_id``: the nodes of those STIX ids, null where there is none.

    Of several nodes with one STIX id the smallest id counts.
    """
    known = nodes.select(F.element_at("properties", "stix_id").alias("_ref"), "id").filter("_ref IS NOT NULL").groupBy("_ref").agg(F.min("id").alias("_node"))
    for end in ("source", "target"):
        relations = relations.join(known.select(F.col("_ref").alias(f"{end}_ref"), F.col("_node").alias(f"{end}_id")), f"{end}_ref", "left")
    return relations


def place_indicators(nodes: DataFrame, geo: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Country nodes and LOCATED_IN edges of the IPv4 indicators among the nodes; ``geo`` has ``low, high, country``."""
    ips = nodes.select("id", F.element_at("properties", "value").alias("value"), F.element_at("properties", "type").alias("_t")).filter("_t IN ('ip', 'ipv4')")
    placed = enrich_geo(ips.filter(is_valid_indicator(F.col("value"), F.lit("ipv4"))), "value", geo.select("low", "high", "country")).filter("country IS NOT NULL").select("id", "country").distinct()
    country = F.concat(F.lit("country:"), "country")
    return placed.select("country").distinct().select(country.alias("id"), F.lit("Country").alias("label"), F.create_map(F.lit("name"), F.col("country")).alias("properties")), placed.select(F.col("id").alias("source_id"), country.alias("target_id"), F.lit("LOCATED_IN").alias("type"))


def ingest(raw: DataFrame, now: Column, geo: DataFrame | None = None, details: DataFrame | None = None, summarise: Callable[[pd.Series], pd.Series] | None = None, known: DataFrame | None = None) -> Ingested:
    """``url, fetched_at, payload`` (and ``topic``, else raw.intel) -> graph nodes and edges, each once, dead letters, and the account.

    Equal payloads count once (the first by time, then URL); the others are duplicates.  Each
    kind of payload is normalised and becomes a changeset: feed entries with the entities of
    their texts, indicator lists, STIX objects and, between nodes of this batch or of
    ``known``, STIX relations.  Enrichment between extraction and changeset: ``geo`` places IPv4
    indicators in countries, ``details`` (``value, details`` map) adds properties to
    indicators by value, ``summarise`` is asked for a summary of each long entry.

    Every payload and every item of one goes to the graph, to a dead letter that says why, or
    (payloads) is a duplicate: ``account`` has ``level, kind, destination, n`` with ``in`` counted
    where they come in and the others where they end, so ``in`` is their sum.
    """
    from ..streaming.streams import dead_letter

    topic = F.col("topic") if "topic" in raw.columns else F.lit("raw.intel")
    hashed = raw.select("url", "fetched_at", "payload", topic.alias("topic"), F.sha2(F.coalesce("payload", F.lit("")), 256).alias("_h"))
    # Pre-aggregated before the shuffle, so a payload sent very often is one row a task.
    first = hashed.groupBy("_h").agg(F.min(F.struct("fetched_at", "url", "topic")).alias("_f"), F.first("payload").alias("payload"), F.count(F.lit(1)).alias("_n"))
    first = first.select("_f.*", "payload", "_n", detect_payload_kind(F.col("payload"), F.col("_f.url")).alias("kind"))
    doc = F.try_parse_json(F.col("payload"))
    sized = reduce(lambda a, k: a.when(F.col("kind") == k, F.size(F.try_variant_get(doc, ITEM_PATHS[k], "array<variant>"))), ITEM_PATHS, F.when(F.lit(False), 0))
    why = F.when(doc.isNull(), "not JSON").when(~F.col("kind").isin(*ITEM_PATHS), F.concat(F.lit("kind "), "kind")).when(F.coalesce("_items", F.lit(0)) < 1, "no items")
    first = written(first.withColumn("_items", sized).withColumn("why", why))
    good = first.filter("why IS NULL")
    keep = [F.col(c) for c in ("url", "fetched_at", "topic")]
    of = lambda kind: _items(good.filter(F.col("kind") == kind), kind, "payload", now, keep, doc)
    item = lambda df, kind: df.withColumns({"kind": F.lit(kind), "item": F.to_json(F.struct(*[c for c in df.columns if c not in ("url", "fetched_at", "topic", "error")]))})

    text = F.concat_ws("\n", "title", "content", "summary")
    found = F.create_map(*[x for k, kinds in NODE_KINDS.items() for x in (F.lit(k), F.array_distinct(F.concat(*[F.regexp_extract_all(entity_text(text, e), F.lit(ENTITIES[e][0]), F.lit(0)) for e in kinds])))])
    feeds = {k: of(k) for k in ("rss_feed", "atom_feed")}
    entries = reduce(DataFrame.unionByName, feeds.values()).filter("error IS NULL").select(F.coalesce("link", "url").alias("url"), "title", found.alias("entities"), text.alias("_text"))
    iocs = of("misp_feed")
    objects = of("stix_bundle")
    related = F.lower("type") == "relationship"
    things = objects.filter(F.col("error").isNull() & ~related)
    parts = [intel_to_changeset(entries.drop("_text")), iocs_to_changeset(iocs.filter("error IS NULL").select(F.col("url").alias("feed_url"), F.col("fetched_at").cast("string").alias("fetched_at"), "value", "type"))]
    stix_nodes = stix_to_changeset(things)[0]
    ends = stix_nodes if known is None else stix_nodes.unionByName(known.select("id", "label", "properties"))
    relations = resolve_relations(objects.filter(F.col("error").isNull() & related), ends)
    relations = relations.withColumn("error", F.when(F.col("source_id").isNull() | F.col("target_id").isNull(), "end of relation not known"))
    nodes, edges = [n for n, _ in parts] + [stix_nodes], [e for _, e in parts]
    edges.append(relations.filter("error IS NULL").select("source_id", "target_id", F.upper("relationship_type").alias("type")))
    if summarise is not None:
        asked, _ = enrich_with(entries, "_text", summarise, F.length("_text") > 300)
        article = intel_to_changeset(asked.select("url", "title", F.map_from_arrays(F.array(F.lit("ip")), F.array(F.array().cast("array<string>"))).alias("entities"), "answer"), {"summary": F.col("answer")})[0]
        nodes.append(article)
    merged = one_node_each(reduce(DataFrame.unionByName, nodes))
    if details is not None:
        more = details.select(F.col("value").alias("_value"), "details").groupBy("_value").agg(F.max_by("details", F.to_json("details")).alias("_d"))
        props = F.map_zip_with("properties", F.coalesce("_d", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, a, b: F.coalesce(a, b))
        merged = merged.withColumn("_value", F.when(F.col("label") == "Indicator", F.element_at("properties", "value"))).join(more, "_value", "left").select("id", "label", props.alias("properties"))
    if geo is not None:
        merged = written(merged)
        countries, located = place_indicators(merged, geo)
        merged, edges = merged.unionByName(countries), [*edges, located]

    every = [*[item(df, k) for k, df in feeds.items()], item(iocs, "misp_feed"), item(objects.filter(F.col("error").isNotNull() | ~related), "stix_bundle"), item(relations.drop("source_id", "target_id"), "stix_bundle")]
    told = reduce(DataFrame.unionByName, [df.select("topic", "kind", "item", "error") for df in every])
    lost = first.filter("why IS NOT NULL").select("topic", F.coalesce("payload", F.lit("")).alias("item"), F.col("why").alias("error"))
    dead = dead_letter(lost.unionByName(told.filter("error IS NOT NULL").select("topic", "item", "error")), F.col("topic"), F.col("item"), F.col("error"), "normalization", "ingest", now)
    count = lambda level, destination, df, n=F.lit(1): df.groupBy("kind").agg(F.sum(n).cast("long").alias("n")).select(F.lit(level).alias("level"), "kind", F.lit(destination).alias("destination"), "n")
    account = [count("payload", "in", first, F.col("_n")), count("payload", "duplicate", first, F.col("_n") - 1), count("payload", "dead", first.filter("why IS NOT NULL")), count("payload", "graph", good)]
    account += [count("item", "in", good, F.col("_items")), count("item", "dead", told.filter("error IS NOT NULL")), count("item", "graph", told.filter("error IS NULL"))]
    return Ingested(merged, reduce(DataFrame.unionByName, edges).distinct(), dead, reduce(DataFrame.unionByName, account).filter("n > 0"))
