"""Property graphs as two tables: changesets, merges, neighbourhoods, paths and patterns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import overlaps, signed, small, written

# Labels by STIX type and by entity kind.
STIX_LABELS = {"attack-pattern": "AttackPattern", "campaign": "Campaign", "intrusion-set": "ThreatActor", "threat-actor": "ThreatActor", "malware": "Malware", "vulnerability": "Vulnerability", "tool": "Tool", "identity": "Identity"}
ENTITY_LABELS = {"ip": "Indicator", "domain": "Indicator", "url": "Indicator", "hash": "Indicator", "email": "Indicator", "cve": "Vulnerability", "threat_actor": "ThreatActor", "malware": "Malware", "attack_pattern": "AttackPattern", "campaign": "Campaign", "vulnerability": "Vulnerability"}

NODE = "struct<id:string,label:string,properties:map<string,string>>"
EDGE = "struct<source_id:string,target_id:string,type:string>"


def _node(id_: Column, label: Column | str, **props: Column) -> Column:
    return F.struct(id_.alias("id"), (F.lit(label) if isinstance(label, str) else label).alias("label"), F.create_map(*[x for k, v in props.items() for x in (F.lit(k), v.cast("string"))]).alias("properties")).cast(NODE)


def _edge(a: Column, b: Column, kind: str) -> Column:
    return F.struct(a.alias("source_id"), b.alias("target_id"), F.lit(kind).alias("type")).cast(EDGE)


def _short(col: Column, n: int = 8) -> Column:
    return F.substring(F.md5(col), 1, n)


def _tables(df: DataFrame, nodes: Column, edges: Column) -> tuple[DataFrame, DataFrame]:
    return df.select(F.inline(nodes)), df.select(F.inline(edges))


def _lookup(table: dict[str, str], key: Column, other: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), key), other)


def articles_to_changeset(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``source_url, retrieved_at, title, full_text`` -> Source, SightingEvent and Article nodes; REPORTED_BY and ABOUT edges."""
    domain = F.coalesce(F.nullif(F.regexp_extract("source_url", "^[^:]+://([^/?#]*)", 1), F.lit("")), F.lit("unknown"))
    clean = F.left(F.regexp_replace(F.coalesce("title", F.lit("")), r"[^\p{L}\p{N}_\s-]", ""), F.lit(50))
    df = df.withColumns({"_d": domain, "_s": F.concat(F.lit("source:"), domain), "_e": F.concat(F.lit("event:"), domain, F.lit(":"), _short(F.concat("source_url", F.lit("|"), "retrieved_at")))})
    df = df.withColumn("_a", F.concat(F.lit("article:"), "_d", F.when(F.length(clean) > 0, F.concat(F.lit(":"), clean)).otherwise(""), F.lit(":"), _short(F.col("source_url"))))
    c = F.col
    nodes = F.array(_node(c("_s"), "Source", url=c("source_url"), domain=c("_d")), _node(c("_e"), "SightingEvent", timestamp=c("retrieved_at")), _node(c("_a"), "Article", url=c("source_url"), title=c("title"), full_text=c("full_text")))
    return _tables(df, nodes, F.array(_edge(c("_e"), c("_s"), "REPORTED_BY"), _edge(c("_a"), c("_e"), "ABOUT")))


def iocs_to_changeset(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``feed_url, fetched_at, value, type`` -> MispEvent and Indicator (or ThreatActor for APT names) nodes; APPEARED_IN edges."""
    event = F.concat(F.lit("misp_event:"), _short(F.col("feed_url")), F.lit(":"), "fetched_at")
    actor = F.col("value").rlike("(?i)^APT[0-9]+")
    item = F.when(actor, F.concat(F.lit("threat_actor:"), F.lower("value"))).otherwise(F.concat(F.lit("indicator:"), "type", F.lit(":"), _short(F.col("value"))))
    df = df.withColumns({"_e": event, "_i": item, "_l": F.when(actor, "ThreatActor").otherwise("Indicator")})
    c = F.col
    return _tables(df, F.array(_node(c("_e"), "MispEvent", feed_url=c("feed_url")), _node(c("_i"), c("_l"), value=c("value"), type=c("type"))), F.array(_edge(c("_i"), c("_e"), "APPEARED_IN")))


def stix_to_changeset(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, type, name, source_ref, target_ref, relationship_type`` -> one node an object, one edge a relationship."""
    kind = F.lower("type")
    rel = kind == "relationship"
    tail = F.left(F.element_at(F.split("id", "--"), -1), F.lit(8))
    name = F.replace(F.left(F.regexp_replace(F.coalesce("name", F.lit("")), r"[^\p{L}\p{N}_\s-]", ""), F.lit(30)), F.lit(" "), F.lit("_"))
    node_id = F.concat(kind, F.lit(":"), F.when(F.length(name) > 0, F.concat(name, F.lit(":"))).otherwise(""), tail)
    nodes = df.filter(~rel).select(F.inline(F.array(_node(node_id, _lookup(STIX_LABELS, kind, F.replace(F.initcap(F.replace(kind, F.lit("-"), F.lit(" "))), F.lit(" "), F.lit(""))), stix_id=F.col("id"), name=F.col("name")))))
    return nodes, df.filter(rel).select(F.col("source_ref").alias("source_id"), F.col("target_ref").alias("target_id"), F.upper("relationship_type").alias("type"))


def intel_to_changeset(df: DataFrame, more: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """``url, title, entities`` (map of kind to values) -> Article and entity nodes, MENTIONS edges; without a URL a NormalizedIntel node and CONTAINS edges; ``more`` are further properties of the first."""
    url = F.nullif(F.col("url"), F.lit(""))
    domain = F.coalesce(F.nullif(F.regexp_extract("url", "^[^:]+://([^/?#]*)", 1), F.lit("")), F.lit("unknown"))
    root = F.when(url.isNotNull(), F.concat(F.lit("article:"), domain, F.lit(":"), _short(url))).otherwise(F.concat(F.lit("normalized:"), _short(F.to_json("entities"), 12)))
    df = df.withColumns({"_r": root, "_has": url.isNotNull()})
    each = df.select("_r", "_has", F.explode("entities").alias("kind", "values")).select("_r", "_has", "kind", F.explode("values").alias("value")).filter(F.length("value") > 0)
    each = each.withColumn("_e", F.concat("kind", F.lit(":"), _short(F.col("value"), 12)))
    c = F.col
    nodes = df.select(F.inline(F.array(_node(c("_r"), F.when(c("_has"), "Article").otherwise("NormalizedIntel"), url=c("url"), title=c("title"), **(more or {})))))
    nodes = nodes.unionByName(each.select(F.inline(F.array(_node(c("_e"), _lookup(ENTITY_LABELS, c("kind"), F.lit("Entity")), value=c("value"), type=c("kind"))))))
    return nodes, each.select(c("_r").alias("source_id"), c("_e").alias("target_id"), F.when(c("_has"), "MENTIONS").otherwise("CONTAINS").alias("type"))


def relations_to_changeset(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``url, entities, relations`` (``source, target, type, confidence``) -> nodes of ends that are no entity, and edges with their ``confidence``.

    An end is the entity of the same record with that value (of several kinds the first in
    order), named as ``intel_to_changeset`` names it; another end becomes an Entity node
    ``entity:<hash>``, so no edge hangs.  Types are upper-case with underscores, RELATED_TO
    where there is none; confidence is .5 where there is none.  Relations without both ends go,
    equal edges of all records are one with the highest confidence.
    """
    have = F.flatten(F.transform(F.array_sort(F.map_entries(F.coalesce("entities", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))))), lambda e: F.transform(F.coalesce(e["value"], F.array().cast("array<string>")), lambda v: F.struct(e["key"], v)))).cast("array<struct<kind:string,value:string>>")
    each = df.select(have.alias("_have"), F.explode("relations").alias("_r")).filter((F.length("_r.source") > 0) & (F.length("_r.target") > 0))
    kind = lambda end: F.try_element_at(F.filter("_have", lambda e: e["value"] == end), F.lit(1))["kind"]
    name = lambda end: F.concat(F.coalesce(kind(end), F.lit("entity")), F.lit(":"), _short(end, 12))
    ends = {end: F.col(f"_r.{end}") for end in ("source", "target")}
    type_ = F.replace(F.upper(F.coalesce(F.nullif("_r.type", F.lit("")), F.lit("related to"))), F.lit(" "), F.lit("_"))
    rows = each.select(*[name(c).alias(f"{end}_id") for end, c in ends.items()], *[F.when(kind(c).isNull(), c).alias(f"_{end}") for end, c in ends.items()], type_.alias("type"), F.coalesce(F.col("_r.confidence").cast("double"), F.lit(0.5)).alias("confidence"))
    alone = rows.select(F.explode(F.array("_source", "_target")).alias("_v")).filter("_v IS NOT NULL").distinct()
    nodes = alone.select(F.inline(F.array(_node(F.concat(F.lit("entity:"), _short(F.col("_v"), 12)), "Entity", value=F.col("_v"), type=F.lit("entity")))))
    return nodes, rows.groupBy("source_id", "target_id", "type").agg(F.max("confidence").alias("confidence"))


def raw_to_changeset(df: DataFrame, record: str = "record", id_: str = "$.id") -> tuple[DataFrame, DataFrame]:
    """JSON records of no known shape -> RawIntel nodes with all fields as properties, and no edges.

    A node is named by the record's id, else by a hash of the record with sorted keys.  Fields of
    other types stand as JSON; null fields are left out.  What is no JSON object makes no node.
    """
    kind = "map<string,variant>"
    fields = df.select(F.try_parse_json(record).alias("_j")).select("_j", F.try_variant_get("_j", "$", kind).alias("_m")).filter("_m IS NOT NULL")
    text = F.map_from_entries(F.array_sort(F.filter(F.transform(F.map_entries("_m"), lambda e: F.struct(e["key"].alias("k"), e["value"].cast("string").alias("v"))), lambda e: e["v"].isNotNull())))
    fields = fields.select(F.nullif(F.try_variant_get("_j", id_, "string"), F.lit("")).alias("_id"), text.alias("_p"))
    named = F.coalesce("_id", F.concat(F.lit("raw:"), _short(F.to_json("_p"), 12)))
    return fields.select(named.alias("id"), F.lit("RawIntel").alias("label"), F.col("_p").alias("properties")), df.sparkSession.createDataFrame([], "source_id string, target_id string, type string")


def to_changeset(df: DataFrame, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """Mixed JSON records -> nodes and edges, each record by the first shape it has.

    In order: an article (``source_url, retrieved_at``), an indicator of a list
    (``source = misp``, ``ioc_record``), an object or relation of a bundle (``source = taxii``,
    ``stix_object``), normalised intelligence (``entities, relations, raw_payload``; the URL is the
    payload's ``source_url, url`` or ``link``, else the record's ``id``), and RawIntel.  Ends
    of STIX relations keep their references: ``ingest.resolve_relations`` names the nodes.
    """
    j = F.col("_j")
    at = lambda path, kind="string": F.try_variant_get(j, path, kind)
    has = lambda *paths: reduce(lambda a, b: a & b, [at(p, "variant").isNotNull() for p in paths])
    shape = F.when(has("$.source_url", "$.retrieved_at"), "article").when((at("$.source") == "misp") & has("$.ioc_record"), "ioc").when((at("$.source") == "taxii") & has("$.stix_object"), "stix").when(has("$.entities", "$.relations", "$.raw_payload"), "intel").otherwise("raw")
    rows = df.select(F.col(record).alias("record"), F.try_parse_json(record).alias("_j")).withColumn("_k", shape)
    of = lambda kind, **cols: rows.filter(F.col("_k") == kind).select(*[c.alias(n) for n, c in cols.items()])
    some = lambda *paths: F.coalesce(*[F.nullif(at(p), F.lit("")) for p in paths])
    text = lambda path: F.coalesce(at(path), F.lit(""))
    intel = of("intel", url=some("$.raw_payload.source_url", "$.raw_payload.url", "$.raw_payload.link", "$.id"), title=text("$.raw_payload.title"), entities=at("$.entities", "map<string,array<string>>"), relations=at("$.relations", "array<struct<source:string,target:string,type:string,confidence:double>>"))
    related = relations_to_changeset(intel)
    parts = [
        articles_to_changeset(of("article", source_url=at("$.source_url"), retrieved_at=at("$.retrieved_at"), title=at("$.title"), full_text=text("$.full_text"))),
        iocs_to_changeset(of("ioc", feed_url=text("$.feed_url"), fetched_at=text("$.fetched_at"), value=text("$.ioc_record.value"), type=F.coalesce(at("$.ioc_record.type"), F.lit("unknown")))),
        stix_to_changeset(of("stix", **{c: at(f"$.stix_object.{c}") for c in ("id", "type", "name", "source_ref", "target_ref", "relationship_type")})),
        intel_to_changeset(intel.select("url", "title", "entities")),
        (related[0], related[1].drop("confidence")),
        raw_to_changeset(of("raw", record=F.col("record"))),
    ]
    return reduce(DataFrame.unionByName, [n for n, _ in parts]), reduce(DataFrame.unionByName, [e for _, e in parts]).distinct()


def merge_graph(nodes: DataFrame, delta: DataFrame, version: str = "version") -> DataFrame:
    """One node a key; of properties set more than once the latest version's value stays."""
    both = nodes.unionByName(delta)
    each = both.select("id", "label", version, F.explode_outer("properties").alias("k", "v"))
    last = each.groupBy("id", "label", "k").agg(F.max_by("v", version).alias("v"))
    return last.groupBy("id", "label").agg(F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "v"))))).alias("properties"))


def technique_links(nodes: DataFrame, techniques: DataFrame) -> DataFrame:
    """DESCRIBES edges from indicators whose value is a technique id to the technique."""
    named = nodes.filter((F.col("label") == "Indicator") & F.col("name").rlike(r"^T[0-9]+(\.[0-9]+)*$"))
    return named.join(techniques, named["name"] == techniques["technique"]).select(F.col("id").alias("source_id"), F.col("technique").alias("target_id"), F.lit("DESCRIBES").alias("type"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source_id").alias("a"), F.col("target_id").alias("b")).unionByName(edges.select(F.col("target_id").alias("a"), F.col("source_id").alias("b"))).distinct()


def neighbors(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """``origin, id, hops``: everything within so many hops of the start nodes, with the least number of hops.

    What each hop finds is written, so the plan does not grow with the depth.
    """
    link = written(_both_ways(edges))
    seen = start.select(F.col("id").alias("origin"), "id", F.lit(0).alias("hops"))
    front = seen
    for hop in range(1, depth + 1):
        found = front.join(link, front["id"] == link["a"]).select("origin", F.col("b").alias("id"), F.lit(hop).alias("hops")).distinct()
        front = written(found.join(seen.select("origin", "id"), ["origin", "id"], "left_anti"))
        seen = seen.unionByName(front)
    return seen


def shortest_path(edges: DataFrame, a: str, b: str, most: int = 6) -> DataFrame:
    """``path``: one shortest path between two nodes (of several the smallest in order), no row if there is none within ``most`` hops.

    The search goes from both ends, each time from the smaller front, and every front keeps for
    each node the smallest path to its end.  Edges are only scanned where a front is small enough to be broadcast.
    """
    spark = edges.sparkSession
    # Not made distinct: a front keeps one path a node anyway.
    link = written(edges.select(F.col("source_id").alias("a"), F.col("target_id").alias("b")))
    fronts = [written(spark.createDataFrame([(x, [x])], "id string, path array<string>")) for x in (a, b)]
    seen, sizes = [f.select("id") for f in fronts], [1, 1]
    for hop in range(most + 1):
        # Every shortest path of so many hops has one node in both fronts.
        parts = fronts[0].join(small(fronts[1].select("id", F.col("path").alias("_rest"))), "id")
        hit = written(parts.agg(F.min(F.concat("path", F.slice("_rest", F.lit(2), F.greatest(F.lit(0), F.size("_rest") - 1)))).alias("path")).filter("path IS NOT NULL"))
        if hop == most or not all(sizes) or not hit.isEmpty():
            return hit
        at = 0 if sizes[0] <= sizes[1] else 1
        front = small(fronts[at])
        ways = [front.join(link, front["id"] == link[x]).select(F.col(y).alias("id"), (F.concat("path", F.array(y)) if at == 0 else F.concat(F.array(y), "path")).alias("path")) for x, y in (("a", "b"), ("b", "a"))]
        found = ways[0].unionByName(ways[1]).groupBy("id").agg(F.min("path").alias("path"))
        fronts[at] = written(found.join(small(seen[at]), "id", "left_anti"))
        seen[at], sizes[at] = seen[at].unionByName(fronts[at].select("id")), fronts[at].count()


def graph_query(spark: SparkSession, text: str, nodes: DataFrame, edges: DataFrame, **params) -> DataFrame:
    """A parameterised SQL query over ``{nodes}`` and ``{edges}``."""
    return spark.sql(text, args=params or None, nodes=nodes, edges=edges)


def match_path(nodes: DataFrame, edges: DataFrame, labels: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Chains ``n0 -type-> n1 ...`` of nodes with the given labels."""
    out = nodes.filter(F.col("label") == labels[0]).select(F.col("id").alias("n0"))
    for i, kind in enumerate(types):
        step = edges.filter(F.col("type") == kind).select(F.col("source_id").alias(f"n{i}"), F.col("target_id").alias(f"n{i + 1}"))
        goal = nodes.filter(F.col("label") == labels[i + 1]).select(F.col("id").alias(f"n{i + 1}"))
        out = out.join(step, f"n{i}").join(goal, f"n{i + 1}", "left_semi")
    return out.select(*[f"n{i}" for i in range(len(labels))])


def graph_priority(known: Column, reputation: Column, unseen: Column, gap: Column, age_days: Column) -> Column:
    """Points for a known domain, its reputation, indicators not seen before (five at most), the gap filled and recency, held in [0, 1]."""
    score = F.when(known, F.lit(0.2) + F.when(reputation > 0.7, 0.15).otherwise(0.0)).otherwise(0.0) + 0.1 * F.least(F.lit(5), unseen) + 0.3 * gap
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score + F.when(age_days <= 1, 0.2).when(age_days <= 7, 0.1).otherwise(0.0)))


def _host(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^[^:]+://([^/?#]*)", 1)


def domain_reputation(domains: DataFrame, sources: DataFrame, gram: int = 8) -> DataFrame:
    """``domain, known_sources, reputation``: how many source URLs contain each domain anywhere, and their mean reputation.

    Containment as an equi-join: a domain gives the ``gram`` letters after its first four (fewer
    where it is shorter, then from the start), a source every stretch of such a length, once;
    what meets is then compared whole.  Domains without a source and empty ones are left out.
    """
    long = F.length("domain") >= gram + 4
    asked = domains.filter("domain <> ''").distinct()
    asked = asked.withColumn("_g", F.when(long, F.substring("domain", 5, gram)).otherwise(F.substring("domain", 1, gram))).withColumn("_n", F.length("_g"))
    sizes = [r[0] for r in asked.select("_n").distinct().collect()]  # at most ``gram`` numbers
    each = sources.select(F.col("url").alias("_url"), F.col("reputation").alias("_rep"), F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("_n")).filter(F.length("_url") >= F.col("_n"))
    starts = F.sequence(F.lit(1), F.length("_url") - F.col("_n") + 1)
    each = each.withColumn("_g", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("_url"), i, F.col("_n"))))))
    met = asked.join(each, ["_g", "_n"]).filter(F.contains("_url", "domain"))
    return met.groupBy("domain").agg(F.count(F.lit(1)).alias("known_sources"), F.avg("_rep").alias("reputation"))


def actor_coverage(actors: DataFrame, mentions: DataFrame) -> DataFrame:
    """``actor, articles``: mentions of the indicators of each actor (``actor, indicator``) in articles (``article, indicator``), 0 for none."""
    counted = mentions.groupBy("indicator").agg(F.count(F.lit(1)).alias("_n"))
    return actors.join(counted, "indicator", "left").groupBy("actor").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("articles"))


def graph_priorities(urls: DataFrame, sources: DataFrame, indicators: DataFrame, coverage: DataFrame, now: Column, key: str = "page_id", enough: int = 5) -> DataFrame:
    """``urls`` with ``known, reputation, unseen, gap, age_days`` from the graph and ``graph_priority``.

    ``urls`` has ``url, published`` (a timestamp or null) and arrays ``indicators`` and ``actors``;
    ``sources`` (``url, reputation``) are the graph's sources, ``indicators`` its ``value``s,
    ``coverage`` counts ``articles`` by ``actor``.  Of the first five indicators those that the
    graph lacks count, repeats as often as they come; of the first three actors those with
    fewer than ``enough`` articles give .2 of a gap each.  ``key`` names a row; rows without a
    host are not known; null arrays have nothing; ages are whole days.
    """
    urls = urls.withColumn("domain", _host(F.col("url")))
    known = domain_reputation(urls.select("domain"), sources)
    have = small(indicators.select(F.col("value").alias("_v")).filter("_v IS NOT NULL").distinct().withColumn("_have", F.lit(1)))
    first = urls.select(key, F.explode(F.slice("indicators", 1, 5)).alias("_v")).join(have, "_v", "left")
    unseen = first.groupBy(key).agg(F.sum(F.when(F.col("_have").isNull(), 1).otherwise(0)).alias("unseen"))
    thin = small(coverage.select(F.col("actor").alias("_a"), F.col("articles").alias("_n")))
    gaps = urls.select(key, F.explode(F.slice("actors", 1, 3)).alias("_a")).join(thin, "_a", "left")
    gaps = gaps.groupBy(key).agg((F.sum(F.when(F.coalesce("_n", F.lit(0)) < enough, 1).otherwise(0)) * 0.2).alias("gap"))
    out = urls.join(small(known), "domain", "left").join(unseen, key, "left").join(gaps, key, "left")
    days = F.floor((F.unix_micros(now) - F.unix_micros("published")) / 86_400_000_000)
    out = out.withColumns({"known": F.coalesce(F.col("known_sources") > 0, F.lit(False)), "reputation": F.coalesce("reputation", F.lit(0.0)), "unseen": F.coalesce("unseen", F.lit(0)), "gap": F.coalesce("gap", F.lit(0.0)), "age_days": days}).drop("known_sources", "domain")
    return out.withColumn("graph_priority", graph_priority(F.col("known"), F.col("reputation"), F.col("unseen"), F.col("gap"), F.col("age_days")))


def indicator_cooccurrence(mentions: DataFrame, article: str, indicator: str) -> DataFrame:
    """Pairs of articles a < b with the number of indicators that they share.

    Pairs whose signatures say that one indicator is all that they share are told where they
    meet; only the others are shuffled and added up.  Repeated mentions count once.
    """
    rows = written(signed(mentions, article, indicator))
    one = overlaps(rows, several=False).withColumn("shared", F.lit(1).cast("long"))
    return one.unionByName(overlaps(rows, several=True).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")))
