"""Registered queries of what sources, parsers and stages do, over pages and payloads made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.functions import dom, tables
from casebook.functions import text as T
from casebook.functions import urn as U
from casebook.operators import near
from casebook.operators import relational as R
from casebook.operators import temporal
from casebook.plans import debates, decisions, judgments, stages, statutes
from casebook.queries import CITED, URN_SQL, V1, V2, _cited, query, t, urn_mint, v1, v2
from casebook.sources import datasource, store
from casebook.sources.shared import TASK_ROWS, shared_dir, spread
from casebook.streaming import keyed


def pick(key, *values):
    """The value of a row by its key's remainder."""
    return F.get(F.array(*(v if hasattr(v, "alias") else F.lit(v) for v in values)), (key % len(values)).cast("int"))


def said(*parts):
    return F.concat(*(p if hasattr(p, "alias") else F.lit(p) for p in parts))


def text_of(c):
    return F.col(c).cast("string")


# ---- Expressions


@query("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Oral Answer' WHEN 1 THEN 'Written Answer' WHEN 2 THEN 'Written Answer (not answered)' WHEN 3 THEN 'Oral Statement' WHEN 4 THEN 'Bill Proceedings' END AS label FROM orders")
def section_labels(spark, d):
    return t(spark, d, "orders").select("o_orderkey", T.section_label(pick(F.col("o_orderkey"), "OA", "WA", "WANA", "OS", "BP", "XX")).alias("label"))


@query(f"SELECT o_orderkey, split_part(urn, '@', 1) || ':x' || o_orderkey || '@' || CAST(day AS VARCHAR) AS child, split_part(urn, '@', 1) AS bare, split_part(urn, '@', 1) || '@2020-02-03' AS pinned, CAST(NULL AS VARCHAR) AS refused FROM ({URN_SQL})")
def urn_children(spark, d):
    u = F.col("urn")
    return urn_mint(spark, d).select("o_orderkey", U.child(u, said("x", text_of("o_orderkey"))).alias("child"), U.at(u, F.lit(None).cast("date")).alias("bare"), U.at(u, F.lit("2020-02-03").cast("date")).alias("pinned"), U.at(F.col("judgment"), F.lit("2020-02-03").cast("date")).alias("refused"))


@query("""SELECT c_custkey, c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'The Minister for ' || c_mktsegment WHEN 2 THEN 'Senior Minister of State' END AS role, CASE c_custkey % 3 WHEN 1 THEN 'Seat ' || c_nationkey END AS seat FROM customer""")
def attribution_split(spark, d):
    label = pick(F.col("c_custkey"), said("The Minister for ", F.col("c_mktsegment"), " (", F.col("c_name"), "):"), said("  ", F.col("c_name"), " (Seat ", text_of("c_nationkey"), ")"), said(F.col("c_name"), " (Senior Minister of State) "))
    who = T.split_attribution(label)
    return t(spark, d, "customer").select("c_custkey", who["name"].alias("name"), who["role"].alias("role"), who["seat"].alias("seat"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' - ' || p_type WHEN 1 THEN p_name WHEN 2 THEN p_type ELSE 'Section ' || p_size END AS title FROM part")
def headings(spark, d):
    k = F.col("p_partkey") % 4
    return t(spark, d, "part").select("p_partkey", T.heading(F.when(k < 2, F.col("p_name")).otherwise(""), F.when(k.isin(0, 2), F.col("p_type")), F.col("p_size")).alias("title"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'P' || o_orderkey WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN CAST(o_orderkey % 900 AS VARCHAR) END AS question_no, o_orderkey % 4 <> 3 OR o_orderkey % 5 = 0 AS is_question FROM orders""")
def question_numbers(spark, d):
    k = F.col("o_orderkey")
    n = debates.question_number(F.when(k % 4 == 0, said("P", text_of("o_orderkey"))), F.when(k % 4 == 1, F.col("o_custkey")), F.when(k % 4 == 2, said("on question No. ", (k % 900).cast("string"), " of the day")).otherwise("nothing"))
    return t(spark, d, "orders").select("o_orderkey", n.alias("question_no"), T.is_question(n, F.when(k % 5 == 0, "WA").otherwise("BP")).alias("is_question"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Re ' || c_name ELSE 'In the matter of ' || c_name END AS title, c_name || ' v ' || c_mktsegment AS parties, CASE c_custkey % 5 WHEN 0 THEN 'STATECT' WHEN 1 THEN 'STATECT' WHEN 2 THEN 'FAMCT' WHEN 3 THEN 'FAMCT' ELSE 'SUPCT' END AS authority, c_name AS speaker FROM customer")
def names_and_courts(spark, d):
    k, name = F.col("c_custkey"), F.col("c_name")
    title = F.when(k % 2 == 0, said("Breach of the Protection Obligation By  ", name, " ")).otherwise(said("In the matter of ", name))
    sides = T.parties(said(name, "  v ", F.col("c_mktsegment")))
    return t(spark, d, "customer").select("c_custkey", T.case_name(title).alias("title"), F.array_join(sides, " v ").alias("parties"), T.court_authority(pick(k, "SGDC", "SGMC", "SGFC", "SGHCF", "SGCA")).alias("authority"), debates.vernacular_speaker(said("Vernacular Speech by ", name, " ")).alias("speaker"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Protection' WHEN 1 THEN 'Consent,Accuracy' WHEN 2 THEN 'Accountability' ELSE '' END AS obligations,
CASE o_orderkey % 5 WHEN 0 THEN 'Warning,Directions' WHEN 1 THEN 'Financial Penalty' WHEN 2 THEN 'Undertaking,Directions' WHEN 3 THEN 'Directions,Financial Penalty' ELSE '' END AS types FROM orders""")
def obligations_and_types(spark, d):
    k = F.col("o_orderkey")
    words = lambda *x: F.array(*map(F.lit, x)) if x else F.expr("cast(array() as array<string>)")
    tags = pick(k, words("Protection", "Warning"), words("Financial Penalty"), words(), words("Protectionism"))
    title = pick(k, "Breach of the Consent Obligation", "Breach of the consent and ACCURACY Obligations", "Openness and more", "Unconsented")
    kinds = decisions.decision_types(pick(k, words("Warning", "x"), words("Financial Penalty", "y"), words("Warning"), words("Directions"), words()), F.when(k % 5 == 2, "Voluntary Undertakings").otherwise("Commission's Decisions"), pick(k, "directions were issued", "none", "Directions imposed", "a financial penalty of $10 and directions issued", "no directions"))
    return t(spark, d, "orders").select("o_orderkey", F.array_join(T.obligations_of(tags, title), ",").alias("obligations"), F.array_join(kinds, ",").alias("types"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '[2018] SGPDPC ' || o_orderkey WHEN 1 THEN '[2016] SGPDPCR ' || o_orderkey || ' (NFA)' WHEN 2 THEN '[2025] SGPDPC ' || o_orderkey WHEN 3 THEN '[2023] SGPDPCS ' || o_orderkey END AS citation,
'DP-2018-B' || (o_orderkey % 9) || ',DP-2019-C1' AS case_numbers FROM orders""")
def standalone_citations(spark, d):
    k = text_of("o_orderkey")
    line = pick(F.col("o_orderkey"), said("[2018] SGPDPC [", k, "]"), said("Decision Citation: [2016] sgpdpcr ", k, " (NFA)"), said(" 2025 SGPDPC ", k, " "), said("[2023 SGPDPCS ", k, "]"), "We considered [2018] SGPDPC 21.", said("second\fthird\f\ffourth\n[2018] SGPDPC ", k))
    text = said("PERSONAL DATA PROTECTION COMMISSION\n", line, "\nSee [2011] SGPDPC 1")
    n = (F.col("o_orderkey") % 9).cast("string")
    return t(spark, d, "orders").select("o_orderkey", decisions.standalone_citation(text).alias("citation"), F.array_join(decisions.case_numbers(said("Case DP-2018-B", n, " and DP-2019-C1, XDP-2019-C2, DP-2018-B", n)), ",").alias("case_numbers"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 's' || (o_orderkey % 300) || 'A' WHEN 1 THEN 'r' || (o_orderkey % 300) WHEN 2 THEN 'Sc' || (o_orderkey % 9) || '-X' ELSE 'P' || (o_orderkey % 9) || '1' END AS part_key,
CASE WHEN o_orderkey % 4 = 1 THEN 'urn:sg:sl:C' || o_custkey || ':S' || o_orderkey || '-2020' WHEN o_orderkey % 4 = 3 THEN NULL ELSE 'urn:sg:act:C' || o_custkey END AS root, o_orderkey % 3 = 0 AS deleted, 'CAP. ' || (o_orderkey % 50) || 'A|Chapter 7' AS chapters FROM orders""")
def statute_keys(spark, d):
    k, n = F.col("o_orderkey"), (F.col("o_orderkey") % 300).cast("string")
    anchor = pick(k, said("pr", n, "A-"), said("pr", n, "-he-"), said("Sc", (k % 9).cast("string"), ".X--"), said("P", (k % 9).cast("string"), "1-"))
    code = pick(k, said("C", text_of("o_custkey")), said("C", text_of("o_custkey"), "-S", text_of("o_orderkey"), "-2020"), said("C", text_of("o_custkey")), "lone")
    corpus = pick(k, "act", "sl", "act", "sl")
    aliases = F.array_distinct(F.regexp_extract_all(said("(CAP. ", (k % 50).cast("string"), "A) and Chapter 7, CAP. ", (k % 50).cast("string"), "A, Capital 9"), F.lit(statutes.CHAPTER), F.lit(0)))
    return t(spark, d, "orders").select("o_orderkey", statutes.part_key(anchor, corpus).alias("part_key"), statutes.root_urn(corpus, code).alias("root"), pick(k, "12 (Repealed) x", "12 Repealed", "12").rlike(statutes.DELETED).alias("deleted"), F.array_join(aliases, "|").alias("chapters"))


@query("SELECT o_orderkey, 'https://h/Act/C' || o_custkey || '?DocDate=1&ProvIds=pr1-%2Cpr' || o_orderkey || '-' AS url, 'seg-' || o_orderkey AS segment, CAST((o_orderkey // 1000) AS INTEGER) * 1000 + CAST(o_orderkey % 1000 AS INTEGER) AS total FROM orders")
def addresses(spark, d):
    k = text_of("o_orderkey")
    url = said("https://h/Act/C", text_of("o_custkey"), "?ProvIds=old&DocDate=1#top")
    total = F.regexp_extract(said("Total Judgment(s) Found : ", F.format_number("o_orderkey", 0)), judgments.COUNT.pattern, 1)
    return t(spark, d, "orders").select("o_orderkey", statutes.with_ids(url, F.array(F.lit("pr1-"), said("pr", k, "-"))).alias("url"), decisions.last_segment(said("/a/b/seg-", k, "//")).alias("segment"), F.translate(total, ",", "").cast("int").alias("total"))


@query("""SELECT o_orderkey, d AS dashed, d AS short, d AS long, d AS packed, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE d END AS checked FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_formats(spark, d):
    day = F.to_date("o_orderdate")
    forms = {"dashed": ("dd-MM-yyyy", "dd-MM-yyyy"), "short": ("d MMM yyyy", "d MMM yyyy"), "long": ("dd MMMM yyyy", "d MMMM yyyy"), "packed": ("yyyyMMdd", "yyyyMMdd")}
    read = lambda text, form: F.try_to_timestamp(text, F.lit(form)).cast("date")
    bad = F.when(F.col("o_orderkey") % 7 == 0, said("31 Feb ", F.year(day).cast("string"))).otherwise(F.date_format(day, "d MMM yyyy"))
    return t(spark, d, "orders").select("o_orderkey", *(read(F.date_format(day, a), b).alias(name) for name, (a, b) in forms.items()), read(bad, "d MMM yyyy").alias("checked"))


@query("SELECT n_nationkey, n_name AS a, 'right' AS b, 'only' AS c FROM nation")
def map_merge(spark, d):
    left, right = F.create_map(F.lit("a"), F.col("n_name"), F.lit("b"), F.lit("left")), F.create_map(F.lit("b"), F.lit("right"), F.lit("c"), F.lit("only"))
    m = F.map_concat(F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k)), right)
    return t(spark, d, "nation").select("n_nationkey", *(m[k].alias(k) for k in "abc"))


# ---- Relations


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 20 AND 70 UNION ALL SELECT event_id + 1000000000, 33 FROM events WHERE json_extract_string(props, '$.k') = '33'")
def json_predicates(spark, d):
    e = t(spark, d, "events").withColumnRenamed("props", "meta")
    show = lambda rows, shift: rows.select((F.col("event_id") + shift).alias("event_id"), R.json_field("k", "long").alias("k"))
    return show(R.json_filtered(e, between={"k": (20, 70)}), 0).unionByName(show(R.json_filtered(e, equals={"k": "33"}, any_of={"none": []}), 1000000000))


@query(f"WITH {V2} SELECT key, string_agg(CAST(start AS VARCHAR) || '/' || coalesce(CAST(\"end\" AS VARCHAR), ''), ' ' ORDER BY start) AS available FROM v2 GROUP BY key")
def available_ranges(spark, d):
    ranges = F.transform("available", lambda x: F.concat(x["start"].cast("string"), F.lit("/"), F.coalesce(x["end"].cast("string"), F.lit(""))))
    return temporal.available(v2(spark, d), "key").select("key", F.array_join(ranges, " ").alias("available"))


@query("""WITH RECURSIVE l AS (SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2), x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM l),
w AS (SELECT l_orderkey, l_linenumber, rn, q AS used, CAST(0 AS BIGINT) AS chunk FROM x WHERE rn = 1 UNION ALL SELECT x.l_orderkey, x.l_linenumber, x.rn, CASE WHEN used + q > 60 THEN q ELSE used + q END, CASE WHEN used + q > 60 THEN chunk + 1 ELSE chunk END FROM w JOIN x ON x.l_orderkey = w.l_orderkey AND x.rn = w.rn + 1)
SELECT l_orderkey, l_linenumber, chunk FROM w""")
def greedy_chunks(spark, d):
    rows = t(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").cast("long").alias("q"))
    return R.chunk_by_budget(rows, "l_orderkey", "l_linenumber", "q", 60)


SLUGS = "s AS (SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, p_size, p_partkey % 3 AS m FROM part)"


@query(f"WITH {SLUGS}, u AS (SELECT DISTINCT 'https://h/x/' || slug || CASE m WHEN 0 THEN '' WHEN 1 THEN '-' || p_size ELSE 'y' END AS url, slug || CASE m WHEN 0 THEN '' WHEN 1 THEN '-' || p_size ELSE 'y' END AS segment FROM s) SELECT p_partkey, url FROM s, u WHERE segment = 'z' || p_partkey OR segment = slug OR starts_with(segment, slug || '-')")
def sitemap_candidates(spark, d):
    part = t(spark, d, "part").withColumn("slug", U.slug(F.col("p_name")))
    urls = part.select(said("https://h/x/", F.col("slug"), pick(F.col("p_partkey"), "", said("-", text_of("p_size")), "y")).alias("url")).distinct()
    return decisions.slug_candidates(part.withColumn("href", said("/a/z", text_of("p_partkey"), "/")), urls, "p_partkey", "href", "p_name")


@query("SELECT user_id, count(DISTINCT event_id) AS found, count(*) AS declared FROM events GROUP BY 1")
def reconciliation(spark, d):
    e = t(spark, d, "events")
    return decisions.reconciled(e.join(e.groupBy("user_id").agg(F.count(F.lit(1)).alias("total")), "user_id"), "user_id", "event_id", "total")


@query("SELECT o_orderkey, o_custkey, c_name AS alias_urn FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0")
def alias_resolution(spark, d):
    aliases = t(spark, d, "customer").where("c_custkey % 2 = 0").select(text_of("c_custkey").alias("alias"), F.col("c_name").alias("urn"))
    return R.resolve_aliases(t(spark, d, "orders").select("o_orderkey", "o_custkey", text_of("o_custkey").alias("name")), aliases, "name").select("o_orderkey", "o_custkey", "alias_urn")


@query("""WITH p AS (SELECT 'urn:sg:act:A' || c_nationkey || ':s' || c_custkey AS provision, 'urn:sg:act:A' || c_nationkey AS act, c_nationkey FROM customer),
h AS (SELECT p_partkey, list_distinct(regexp_extract_all(lower(CASE p_size % 3 WHEN 0 THEN r_name || ' REFORM bill' WHEN 1 THEN 'Second Reading: ' || r_name || ' Reform Bill' ELSE 'Fish' END), '[a-z0-9]+')) AS w FROM part JOIN region ON p_partkey % 5 = r_regionkey),
b AS (SELECT r_regionkey, list_distinct(regexp_extract_all(lower(r_name || ' Reform Bill'), '[a-z0-9]+')) AS v FROM region),
l AS (SELECT r_regionkey, p_partkey, round(len(list_intersect(w, v))::DOUBLE / (len(w) + len(v) - len(list_intersect(w, v))), 6) AS c FROM h, b)
SELECT provision, act, 'urn:sg:bill:B' || r_regionkey AS bill, 'urn:sg:hansard:2020-01-01' AS sitting, 'urn:sg:hansard:2020-01-01:s' || p_partkey AS section, round(0.5e0 * c, 6) AS confidence, CASE WHEN p_partkey % 2 = 0 THEN 'urn:sg:hansard:2020-01-01:s' || p_partkey || ':sp0' END AS speech
FROM p JOIN nation ON c_nationkey = n_nationkey JOIN l ON n_regionkey = r_regionkey WHERE c >= 0.5""")
def intent_chain(spark, d):
    none, lit = F.lit(None).cast("string"), F.lit
    region = t(spark, d, "region")
    row = lambda df, urn, corpus, title, parent, level: df.select(urn.alias("urn"), lit(corpus).alias("corpus"), title.alias("title"), parent.alias("parent"), said('{"level": "', level, '"}').alias("meta"))
    acts = row(t(spark, d, "customer"), said("urn:sg:act:A", text_of("c_nationkey"), ":s", text_of("c_custkey")), "act", F.col("c_name"), said("urn:sg:act:A", text_of("c_nationkey")), "provision")
    bills = row(region, said("urn:sg:bill:B", text_of("r_regionkey")), "bill", said(F.col("r_name"), " Reform Bill"), none, "bill")
    part = t(spark, d, "part").join(F.broadcast(region), F.col("p_partkey") % 5 == F.col("r_regionkey"))
    urn = said("urn:sg:hansard:2020-01-01:s", text_of("p_partkey"))
    heading = F.when(F.col("p_size") % 3 == 0, said(F.col("r_name"), " REFORM bill")).when(F.col("p_size") % 3 == 1, said("Second Reading: ", F.col("r_name"), " Reform Bill")).otherwise("Fish")
    docs = acts.unionByName(bills).unionByName(row(part, urn, "hansard", heading, lit("urn:sg:hansard:2020-01-01"), "section")).unionByName(row(part.where("p_partkey % 2 = 0"), said(urn, ":sp0"), "hansard", heading, urn, "speech"))
    refs = t(spark, d, "nation").select(said("urn:sg:act:A", text_of("n_nationkey")).alias("from"), said("urn:sg:bill:B", text_of("n_regionkey")).alias("to"), lit("enacted_by").alias("kind"), lit(0.5).alias("confidence"))
    return R.intent_chain(docs, refs)


QUALITY_SQL = f"""WITH {V1}, q AS (SELECT *, CASE doc_id // 6 % 4 WHEN 0 THEN 'speech' WHEN 1 THEN 'sitting' WHEN 2 THEN 'vernacular' ELSE 'judgment' END AS level FROM v1)
SELECT corpus, CASE corpus WHEN 'hansard' THEN count(*) FILTER (level = 'speech') WHEN 'judgment' THEN count(*) FILTER (level = 'judgment') WHEN 'bill' THEN NULL ELSE count(*) END AS n,
CASE corpus WHEN 'hansard' THEN round(100e0 * count(*) FILTER (level = 'speech' AND doc_id % 5 <> 0) / count(*) FILTER (level = 'speech'), 2) WHEN 'judgment' THEN round(100e0 * count(*) FILTER (level = 'judgment' AND length(text) > 0) / count(*) FILTER (level = 'judgment'), 2)
WHEN 'pdpc' THEN round(100e0 * count(*) FILTER (doc_id % 7 <> 0) / count(*), 2) WHEN 'bill' THEN NULL ELSE round(100e0 * count(*) FILTER (in_force_from IS NOT NULL) / count(*), 2) END AS pct,
CASE WHEN corpus = 'hansard' THEN count(*) FILTER (level = 'sitting') END AS sittings, CASE WHEN corpus = 'hansard' THEN count(*) FILTER (level = 'vernacular') END AS vernacular FROM q GROUP BY corpus"""


def _measured(spark, d):
    k = F.col("doc_id")
    level = pick(F.floor(k / 6), "speech", "sitting", "vernacular", "judgment")
    meta = F.to_json(F.struct(level.alias("level"), F.when(k % 5 != 0, "Mr X").alias("speaker"), (k % 7 == 0).alias("citation_provisional")))
    return v1(spark, d).withColumn("level", level).withColumn("meta", meta)


@query(QUALITY_SQL)
def corpus_quality(spark, d):
    get = lambda *names: F.coalesce(*(F.get_json_object("quality", f"$.{n}") for n in names))
    rows = R.corpus_quality(_measured(spark, d))
    return rows.select("corpus", get("speeches", "judgments", "decisions", "provisions").cast("long").alias("n"), get("attribution_pct", "full_text_pct", "citation_pct", "commencement_pct").cast("double").alias("pct"), get("sittings").cast("long").alias("sittings"), get("vernacular_speeches").cast("long").alias("vernacular"))


@query(f"WITH {V1} SELECT lang AS language, count(*) FILTER (doc_id // 6 % 4 = 0) AS speeches, count(DISTINCT CASE WHEN doc_id % 5 <> 0 THEN 1 END) AS speakers, CAST(sum(length(text)) AS BIGINT) AS characters FROM v1 WHERE corpus = 'hansard' GROUP BY 1")
def text_metrics(spark, d):
    return R.text_metrics(_measured(spark, d).withColumn("language", F.col("lang")))


@query(f"WITH {V1} SELECT corpus, max(issued) AS latest, DATE '2025-01-01' - max(issued) AS age_days, CASE corpus WHEN 'act' THEN DATE '2025-01-01' - max(issued) > 1 WHEN 'sl' THEN DATE '2025-01-01' - max(issued) > 5000 ELSE false END AS overdue FROM v1 GROUP BY corpus")
def freshness(spark, d):
    return stages.freshness(v1(spark, d), {"act": 1, "sl": 5000}, "2025-01-01").withColumn("age_days", F.col("age_days").cast("long"))


@query(f"WITH {V1} SELECT urn FROM v1 WHERE doc_id % 3 = 1 AND doc_id % 2 = 0")
def stale_documents(spark, d):
    k = F.col("doc_id")
    made = F.struct(F.when(k % 2 == 0, "pdpc").otherwise("other").alias("adapter"), F.when(k % 3 == 1, decisions.REVISION - 1).otherwise(decisions.REVISION).alias("parser_rev"))
    return stages.stale(v1(spark, d).withColumn("provenance", made)).select("urn")


@query(rf"""WITH c AS ({CITED}), e AS (
SELECT doc_id, 'neutral' AS resolver, unnest(regexp_extract_all(text, '\[(\d{{4}})\]\s+(SG[A-Z]+(?:\([A-Z]+\))?)\s+(\d+)')) AS raw FROM c
UNION ALL SELECT doc_id, 'report', unnest(regexp_extract_all(text, '\[(\d{{4}})\]\s+(\d+)\s+(SLR|SGLR|MLJ)(?:\(R\))?\s+(\d+)')) FROM c
UNION ALL SELECT doc_id, 'statute', unnest(regexp_extract_all(text, '(?i)\b(?:section|sections|s|ss)\s*(\d+[A-Z]*(?:\([^)]{{1,8}}\))*)(?:\s+of\s+the\s+([A-Z][A-Za-z ()''-]{{3,80}}?\s+Act(?:\s+\d{{4}})?))?')) FROM c)
SELECT DISTINCT 'urn:sg:judgment:W' || doc_id AS from_urn, CASE WHEN resolver = 'neutral' THEN 'urn:sg:judgment:' || regexp_replace(raw, '\[(\d+)\]\s+(\w+)\s+(\d+)', '\1_\2_\3') END AS to_urn, raw, CASE resolver WHEN 'neutral' THEN 0.5e0 ELSE 0e0 END AS confidence, resolver FROM e""")
def enrich_edges(spark, d):
    docs = _cited(spark, d).select(said("urn:sg:judgment:W", text_of("doc_id")).alias("urn"), "text")
    return stages.enrich(docs).select("from_urn", "to_urn", "raw", "confidence", "resolver")


ASKED = "substr(name, 1, CAST(doc_id % 7 AS INTEGER)) || CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE substr(name, CAST(doc_id % 7 AS INTEGER) + 1, 1) || '9' END || substr(name, CAST(doc_id % 7 AS INTEGER) + 2)"
CITES = "SELECT doc_id, '[20' || lpad(CAST(doc_id % 25 AS VARCHAR), 2, '0') || '] SGCA ' || (doc_id % 40) AS name FROM documents"


@query(f"""WITH c AS ({CITES}), n AS (SELECT name, min(doc_id) AS urn FROM c GROUP BY 1), r AS (SELECT doc_id, {ASKED} AS asked FROM c),
p AS (SELECT asked, name, urn, levenshtein(asked, name) AS distance FROM (SELECT DISTINCT asked FROM r), n WHERE levenshtein(asked, name) <= 2 QUALIFY row_number() OVER (PARTITION BY asked ORDER BY distance, name) <= 5)
SELECT doc_id, name, urn, CAST(distance AS INTEGER) AS distance FROM r JOIN p USING (asked)""")
def near_citations(spark, d):
    names = t(spark, d, "documents").select("doc_id", said("[20", F.lpad((F.col("doc_id") % 25).cast("string"), 2, "0"), "] SGCA ", (F.col("doc_id") % 40).cast("string")).alias("name"))
    cut = (F.col("doc_id") % 7).cast("int")
    asked = F.concat(F.substring("name", F.lit(1), cut), F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, "x").otherwise(F.concat(F.substring("name", cut + 1, F.lit(1)), F.lit("9"))), F.substring("name", cut + 2, F.length("name")))
    return near.lookup(names.select("doc_id", asked.alias("asked_for")), "asked_for", near.index(names, "name", "doc_id")).select("doc_id", "name", "urn", "distance")


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents WHERE regexp_matches(text, '\S')")
def pdf_texts(spark, d):
    docs = spread(t(spark, d, "documents").where(F.col("text").rlike(r"\S")).select("doc_id", "text"), "doc_id")
    shown = said("BT /F 9 Tf 10 700 Td <", F.hex(F.encode("text", "UTF-16BE")), "> Tj ET")
    units = "1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfrange <0000> <07FF> <0000> endbfrange"
    file = said("%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Kids [3 0 R] >> endobj\n3 0 obj << /Type /Page /Contents 4 0 R /Resources << /Font << /F 5 0 R >> >> >> endobj\n4 0 obj << /Length ", F.length(shown).cast("string"), " >> stream\n", shown, f"\nendstream endobj\n5 0 obj << /Type /Font /Subtype /Type0 /ToUnicode 6 0 R >> endobj\n6 0 obj << /Length {len(units)} >> stream\n{units}\nendstream endobj\n")
    return docs.select("doc_id", T.squeeze(decisions.file_text(file.cast("binary"))["text"]).alias("text"))


# ---- Stores


@query("SELECT sha256(text) AS sha256, min(doc_id) AS first_doc, CAST(octet_length(encode(any_value(text))) AS BIGINT) AS bytes, any_value(text) AS text FROM documents GROUP BY sha256(text)")
def snapshot_round_trip(spark, d):
    root = shared_dir(spark)
    docs = t(spark, d, "documents")
    rows = docs.select(F.col("text").cast("binary").alias("body"), F.timestamp_seconds("doc_id").alias("retrieved_at"), text_of("doc_id").alias("url"), F.lit("x").alias("adapter"))
    store.put(spark, root, rows)
    store.put(spark, root, rows)
    return store.in_hash_order(store.read_snapshots(spark, root, "x")).select("sha256", F.col("url").cast("long").alias("first_doc"), "bytes", store.body_text(F.col("body")).alias("text"))


@query("SELECT sha256(text) AS sha256, CAST(octet_length(encode(any_value(text))) AS BIGINT) AS bytes, any_value(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY sha256(text)")
def exchange_round_trip(spark, d):
    datasource.register(spark)
    root, bodies = shared_dir(spark), t(spark, d, "documents").where("text is not null").select(F.col("text").cast("binary").alias("body"), F.timestamp_seconds("doc_id").alias("retrieved_at"), F.lit("x").alias("adapter"))
    bodies.write.format("casebook").option("kind", "exchange").mode("append").save(root.removeprefix("file://"))
    back = spark.read.format("casebook").option("kind", "exchange").option("adapter", "x").load(root.removeprefix("file://"))
    return back.select("sha256", "bytes", store.body_text(F.col("body")).alias("text"))


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def stream_units(spark, d):
    root = shared_dir(spark)
    units = keyed.read_files(spark, f"{d}/event[s].parquet", t(spark, d, "events").schema).select("user_id", "event_type", "event_id")
    keyed.written_once(keyed.once_per_key(units, ["user_id", "event_type"], ["event_id"]), f"{root}/units", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/units")


@query("SELECT page_id % 3 AS kind, count(*) AS n, count(*) FILTER (page_id % 2 = 0) AS pdfs FROM pages GROUP BY 1")
def snapshot_kinds(spark, d):
    k = F.col("page_id")
    rows = t(spark, d, "pages").select("page_id", F.to_json(F.struct((k % 3).cast("string").alias("kind"))).alias("params"), F.when(k % 2 == 0, F.lit(b"%PDF-1.4")).otherwise(F.col("html").cast("binary")).alias("body"))
    parts = store.by_kind(rows, ["0", "1", "2"])
    out = None
    for kind, part in parts.items():
        one = part.withColumn("kind", F.lit(int(kind)).cast("long"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(store.is_pdf(F.col("body"))).alias("pdfs"))


@query("SELECT DISTINCT 'u' || user_id AS key, CASE WHEN user_id % 2 = 0 THEN 'empty: no_data' END AS note FROM events WHERE user_id % 3 <> 0")
def checkpoint_marks(spark, d):
    keys = t(spark, d, "events").select(said("u", text_of("user_id")).alias("key"), "user_id")
    done = keys.where("user_id % 3 = 0").select("key").distinct()
    empty = store.mark_empty(done, keys.where("user_id % 2 = 0"), "no_data").select("key", "note")
    return empty.unionByName(store.mark(done, keys.where("user_id % 2 <> 0").select("key")).withColumn("note", F.lit(None).cast("string")))


# ---- Markup


@query("""SELECT page_id, m[2] AS href, replace(m[3], '&amp;', '&') AS text FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a>'), lambda x: ['', regexp_extract(x, 'href="([^"]*)"', 1), regexp_extract(x, '">([^<]*)<', 1)])) AS m FROM pages)""")
def dom_links(spark, d):
    rows = spread(t(spark, d, "pages").select("page_id", "html"), "page_id").select("page_id", dom.nodes(F.col("html")).alias("n"))
    links = F.transform(F.filter("n", lambda x: x["tag"] == "a"), lambda a: F.struct(a["href"].alias("href"), F.array_join(F.transform(F.filter("n", lambda x: (x["pos"] > a["pos"]) & (x["pos"] <= a["last"]) & x["tag"].isNull()), lambda x: x["text"]), "").alias("text")))
    return rows.select("page_id", F.inline(links))


DOM_LINKS = """SELECT page_id, m[2] AS href, replace(m[3], '&amp;', '&') AS text FROM (SELECT page_id, unnest(list_transform(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a>'), lambda x: ['', regexp_extract(x, 'href="([^"]*)"', 1), regexp_extract(x, '">([^<]*)<', 1)])) AS m FROM pages)"""


@query(f"SELECT href, count(*) AS pages, min(page_id) AS first_page, CAST(sum(length(text)) AS BIGINT) AS characters FROM ({DOM_LINKS}) GROUP BY href")
def sql_page_links(spark, d):
    tables.register(spark)
    t(spark, d, "pages").createOrReplaceTempView("casebook_pages")
    return spark.sql("SELECT n.href, count(*) AS pages, min(p.page_id) AS first_page, sum(length(n.text)) AS characters FROM casebook_pages p, LATERAL page_nodes(p.html, 'a') n GROUP BY n.href")


@query(f"WITH {V1} SELECT corpus, count(*) AS texts, CAST(sum(length(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')))) AS BIGINT) AS characters FROM v1 GROUP BY corpus".replace("\\\\", "\\"))
def sql_clean_lengths(spark, d):
    tables.register(spark)
    v1(spark, d).createOrReplaceTempView("casebook_documents")
    return spark.sql("SELECT corpus, count(*) AS texts, sum(length(clean_text(text))) AS characters FROM casebook_documents GROUP BY corpus")


def _lines(items):
    return items.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"))


LINES = "li AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2)"


@query(f"WITH {LINES} SELECT l_orderkey, 'a' || l_linenumber AS anchor, 'head' || part || '|tail & ' || part AS text FROM li UNION ALL SELECT DISTINCT l_orderkey, 'preamble', 'before' FROM li")
def anchor_partition(spark, d):
    one = said('<div id="a', text_of("l_linenumber"), '"><b>head', text_of("part"), "</b><script>x</script></div><p>tail &amp; ", text_of("part"), "</p>")
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", one.alias("x"))))
    items = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    # dealt out by order once: lines, pages and what is in them follow where their order is
    rows = spread(items, "l_orderkey", least=-(-items.count() // TASK_ROWS))
    pages = _lines(rows).groupBy("l_orderkey").agg(said("<div>before", F.array_join(F.transform(lines, lambda x: x["x"]), ""), "</div>").alias("html"), F.transform(F.array_sort(F.collect_list("l_linenumber")), lambda n: said("a", n.cast("string"))).alias("ids"))
    return dom.anchored(pages, "l_orderkey", "html", F.col("ids"), "|").select("l_orderkey", "anchor", "text")


# ---- Parsers, over pages made of rows


def _snapshots(rows, key, body, params):
    """Snapshots of pages made of the rows, which are spread before their pages are made: parsing is the work."""
    return spread(rows, key).select(F.sha2(body.cast("binary"), 256).alias("sha256"), body.cast("binary").alias("body"), F.lit("https://h/").alias("url"), F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("retrieved_at"), params.alias("params"))


@query(f"""WITH {V2}, s AS (SELECT key, min(start) AS first, max(start) AS last, count(*) AS versions FROM v2 GROUP BY key), x AS (SELECT *, 'urn:sg:act:C' || key || '@' || CAST(first AS VARCHAR) AS root, 'urn:sg:act:C' || key || ':' AS p0, '@' || CAST(first AS VARCHAR) AS p1, CASE WHEN versions > 1 THEN (SELECT min(start) FROM v2 WHERE v2.key = s.key AND start > s.first) END AS until FROM s)
SELECT urn, parent, level, text, x.first AS in_force_from, until AS in_force_to, parts FROM x, LATERAL (VALUES
(root, CAST(NULL AS VARCHAR), 'statute', 'Title ' || key, p0 || 'P1' || p1 || '|' || p0 || 'Sc1' || p1),
(p0 || 'P1' || p1, root, 'structure', 'General', p0 || 'P1-D1' || p1),
(p0 || 'P1-D1' || p1, p0 || 'P1' || p1, 'structure', 'Terms', p0 || 's1' || p1 || '|' || p0 || 's2' || p1),
(p0 || 's1' || p1, p0 || 'P1-D1' || p1, 'provision', 'Scope' || chr(10) || '1.—(1) First ' || key || '(a)one;' || chr(10) || '(b)two', p0 || 's1-1' || p1),
(p0 || 's2' || p1, p0 || 'P1-D1' || p1, 'provision', 'Gone' || chr(10) || '2.', ''),
(p0 || 'Sc1' || p1, root, 'structure', 'Schedule text', ''),
(p0 || 's1-1' || p1, p0 || 's1' || p1, 'subprovision', '—(1) First ' || key || '(a)one;' || chr(10) || '(b)two', p0 || 's1-1-a' || p1 || '|' || p0 || 's1-1-b' || p1),
(p0 || 's1-1-a' || p1, p0 || 's1-1' || p1, 'subprovision', '(a)one;', ''), (p0 || 's1-1-b' || p1, p0 || 's1-1' || p1, 'subprovision', '(b)two', '')) AS r(urn, parent, level, text, parts)""")
def statute_documents(spark, d):
    """The first version of each customer's statute: a Part with a Division of two provisions, and a schedule."""
    v = v2(spark, d)
    dates = F.array_sort(F.collect_list("start"))
    rows = v.groupBy("key").agg(dates.alias("days")).withColumn("first", F.col("days")[0]).withColumn("until", F.get("days", F.lit(1)))
    toc = "".join(f'<a class="nav-link" href="#{a}"><span> {b} </span></a>' for a, b in (("top", "Top"), ("P1-", "Part 1 General"), ("P1-D1-", "Division 1 Terms"), ("pr1-", "1 Scope"), ("pr2-", "2 (Deleted) Gone"), ("Sc1-", "First Schedule")))
    links = F.array_join(F.transform("days", lambda x: said('<a href="/Act/C?ValidDate=', F.date_format(x, "yyyyMMdd"), '&amp;x=1">', x.cast("string"), "</a>")), "")
    key = text_of("key")
    body = said(
        '<html><div id="tocPanel">', toc, '</div><button id="versionsButton"> ', F.date_format("first", "dd MMM yyyy"), ' </button><div id="versionsPopover">', links, '</div><div id="legisContent"><p>Title ', key, "</p>",
        '<div id="P1-">General</div><div id="P1-D1-">Terms</div><div class="prov1"><table><tr><td id="pr1-">Scope</td></tr></table><table><tr><td><strong>1.</strong><span class="prov2TxtIL">—(1) First ', key,
        '<table class="p1_1"><tr><td>(<em>a</em>)</td><td>one;</td></tr><tr><td>(<em>b</em>)</td><td>two</td></tr></table></span></td></tr></table></div>',
        '<div class="prov1"><table><tr><td id="pr2-">Gone</td></tr></table><p>2.</p></div><div><a name="Sc1-"></a>Schedule text</div></div></html>')
    ids = F.array(*map(F.lit, ("P1-", "P1-D1-", "pr1-", "pr2-", "Sc1-")))
    item = F.struct(said("C", key).alias("code"), F.lit("act").alias("corpus"), said("Act ", key).alias("title"), F.lit("/Act/C").alias("href"))
    params = F.to_json(F.struct(F.lit("provisions").alias("kind"), item.alias("item"), F.col("first").cast("string").alias("version_start"), F.col("until").cast("string").alias("version_end"), F.lit(True).alias("historical"), ids.alias("requested_ids"), F.lit(True).alias("root_record"), F.lit(1).alias("version_seq")))
    docs = statutes.documents(statutes.pages(_snapshots(rows, "key", body, params)))
    return docs.select("urn", "parent", F.get_json_object("meta", "$.level").alias("level"), "text", "in_force_from", "in_force_to", F.array_join("parts", "|").alias("parts"))


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, 'urn:sg:judgment:2020_SGHC_' || o_orderkey AS urn, '[2020] SGHC ' || o_orderkey AS cite FROM orders)
SELECT urn, CAST(NULL AS VARCHAR) AS parent, cite AS citation, 'judgment' AS level, cite || chr(10) || 'A' || k || ' v B' || chr(10) || '1 First ' || k || chr(10) || 'quoted ' || k || chr(10) || 'Cell A Cell B' || chr(10) || '7 in a quotation' || chr(10) || 'Heading' || chr(10) || '2 Second' || chr(10) || 'X (Firm) for the plaintiff;' AS text, day AS issued, 'A' || k || '|B' AS parties, 'the plaintiff' AS side FROM o
UNION ALL SELECT urn || ':para1', urn, cite || ' at [1]', 'paragraph', '1 First ' || k || chr(10) || 'quoted ' || k || chr(10) || 'Cell A Cell B' || chr(10) || '7 in a quotation', day, 'A' || k || '|B', 'the plaintiff' FROM o
UNION ALL SELECT urn || ':para2', urn, cite || ' at [2]', 'paragraph', '2 Second', day, 'A' || k || '|B', 'the plaintiff' FROM o""")
def judgment_documents(spark, d):
    """A judgment of two printed paragraphs, the first followed by a quotation, a table and a number in a quotation."""
    k = text_of("o_orderkey")
    body = said(
        '<html><div id="divJudgement"><div class="HN-NeutralCit">[2020] SGHC ', k, '</div><div class="HN-CaseName"><span>A', k, "</span> v <span>B</span></div>",
        '<div class="Judg-1">1 First ', k, '</div><div class="Judg-Quote-0">quoted ', k, "</div><table><tr><td>Cell A</td><td>Cell B</td></tr></table><blockquote><div class=\"Judg-1\">7 in a quotation</div></blockquote>",
        '<div class="Judg-Heading-1">Heading</div><div class="Judg-1">2 Second</div><div class="Judg-Lawyers">X (Firm) for the plaintiff;</div></div></html>')
    item = F.struct(said("[2020] SGHC ", k).alias("citation"), F.to_date("o_orderdate").cast("string").alias("issued"))
    params = F.to_json(F.struct(F.lit("judgment").alias("kind"), item.alias("item")))
    docs = judgments.documents(judgments.pages(_snapshots(t(spark, d, "orders"), "o_orderkey", body, params)))
    docs = docs.withColumn("m", F.from_json("meta", "level string, parties array<string>, counsel array<struct<side:string>>"))  # once for a row
    return docs.select("urn", "parent", "citation", "m.level", "text", "issued", F.concat_ws("|", F.get("m.parties", F.lit(0)), F.get("m.parties", F.lit(1))).alias("parties"), F.get("m.counsel", F.lit(0))["side"].alias("side"))


@query("""SELECT 'urn:sg:pdpc:x-breach-' || o_orderkey AS urn, 'Re Org ' || o_orderkey AS title, CAST(o_orderdate AS DATE) AS issued, 'A financial penalty of $' || o_custkey || ' was imposed on Org ' || o_orderkey || chr(10) || chr(10) || 'Read & learn' AS text,
CAST(o_custkey AS BIGINT) AS penalty, CASE WHEN o_orderkey % 2 = 0 THEN 'Protection' ELSE 'Consent' END AS obligations, 'Financial Penalty' AS types FROM orders""")
def decision_documents(spark, d):
    """Decisions whose rich text is in the hydration stream, by reference for every third."""
    k = text_of("o_orderkey")
    rich = said("<p>A financial penalty of $", text_of("o_custkey"), " was imposed on <b>Org</b> ", k, "</p><p>Read &amp; learn</p>")
    inline = said('26:["$","article",null,{"data":{"content":', F.to_json(F.struct(rich.alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(rich.alias("x")))) - 6), "}}]\n")
    pointed = said('26:["$","article",null,{"data":{"content":"$2a"}}]\n2a:T', F.lower(F.hex(F.octet_length(rich))), ",", rich)
    stream = F.when(F.col("o_orderkey") % 3 == 0, pointed).otherwise(inline)
    packet = F.to_json(F.array(stream))
    body = said("<html><script>self.__next_f.push([1,", packet.substr(F.lit(2), F.length(packet) - 1), ")</script></html>")
    title = said("Breach of the ", F.when(F.col("o_orderkey") % 2 == 0, "Protection").otherwise("Consent"), " Obligation by Org ", k)
    item = F.struct(k.alias("id"), F.lit("Commission's Decisions").alias("topic"), title.alias("title"), said("/x/breach-", k).alias("href"), F.date_format("o_orderdate", "dd MMM yyyy").alias("date"))
    params = F.to_json(F.struct(F.lit("detail").alias("kind"), item.alias("item"), F.lit(False).alias("has_pdf")))
    docs = decisions.documents(decisions.pages(_snapshots(t(spark, d, "orders"), "o_orderkey", body, params)))
    get = lambda p: F.get_json_object("meta", f"$.{p}")
    return docs.select("urn", "title", "issued", "text", get("penalty_sgd").cast("long").alias("penalty"), get("obligations[0]").alias("obligations"), get("decision_types[0]").alias("types"))


@query("""WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), s AS (SELECT day, 'urn:sg:hansard:' || CAST(day AS VARCHAR) AS urn FROM o)
SELECT urn, CAST(NULL AS VARCHAR) AS parent, 'sitting' AS level, 'Parliamentary sitting, ' || CAST(day AS VARCHAR) AS title, '' AS text, CAST(NULL AS VARCHAR) AS speaker, urn || ':s0|' || urn || ':s2' AS parts FROM s
UNION ALL SELECT urn || ':s0', urn, 'section', 'Water - Supply', '', NULL, urn || ':s0:sp0|' || urn || ':s0:sp1|' || urn || ':s0:sp2' FROM s
UNION ALL SELECT urn || ':s2', urn, 'section', 'Section 2', '', NULL, urn || ':s2:sp0' FROM s
UNION ALL SELECT urn || ':s0:sp0', urn || ':s0', 'speech', 'Water - Supply', '2.20 pm', NULL, '' FROM s
UNION ALL SELECT urn || ':s0:sp1', urn || ':s0', 'speech', 'Water - Supply', 'I rise on ' || CAST(day AS VARCHAR) || '.' || chr(10) || chr(10) || 'And go on.', 'Mr Lim', '' FROM s
UNION ALL SELECT urn || ':s0:sp2', urn || ':s0', 'speech', 'Water - Supply', 'No.', 'Ms Tan', '' FROM s
UNION ALL SELECT urn || ':s2:sp0', urn || ':s2', 'speech', 'Section 2', '7 Dr Goh asked the Minister whether so.', 'Dr Goh', '' FROM s""")
def debate_documents(spark, d):
    """A sitting of each day that has orders: a section of three speeches, one without text, one with a question."""
    rows = t(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    first = said("<p>2.20 pm</p><p><strong>Mr Lim (Aljunied)</strong>: I rise on ", F.col("day").cast("string"), ".</p><p>And go on.</p><div><p>Ms Tan: No.</p></div>")
    part = lambda title, sub, kind, content: F.struct(F.lit(title).alias("title"), F.lit(sub).alias("subTitle"), F.lit(kind).alias("sectionType"), content.alias("content"))
    parts = F.array(part("Water", "Supply", "OS", first), part("Empty", "", "OS", F.lit("<p> </p>")), part("", "", "OA", F.lit("<p>7 Dr Goh asked the Minister whether so.</p>")))
    payload = F.to_json(F.struct(F.struct(F.date_format("day", "dd-MM-yyyy").alias("sittingDate")).alias("metadata"), parts.alias("takesSectionVOList")))
    docs = debates.documents(_snapshots(rows, "day", payload, F.lit("{}")))
    return docs.select("urn", "parent", F.get_json_object("meta", "$.level").alias("level"), "title", "text", F.get_json_object("meta", "$.speaker").alias("speaker"), F.array_join("parts", "|").alias("parts"))
