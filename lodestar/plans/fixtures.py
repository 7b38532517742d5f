"""The test tables seen as behaviour logs, texts, skill lists and graphs: as DataFrames, and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import checks as C
from lodestar.operators import graph as G


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def log(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Searches, browses, applies from events: a view is a search that shows twenty jobs."""
    e = table(spark, sf, "events").withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
    shown = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: (F.col("k") + i * 7) % 100), ",")
    queries = e.where("event_type = 'view'").select(F.col("event_id").alias("query_id"), F.col("user_id").alias("talent_key"), F.col("ts").alias("query_time"), shown.alias("exposed_jobs"))
    act = lambda kind: e.where(F.col("event_type") == kind).select(F.col("user_id").alias("talent_key"), F.col("k").cast("string").alias("job_id"), F.col("ts").alias("event_time"))
    return queries, act("click"), act("purchase")


def log_jobs(spark, sf) -> DataFrame:
    return table(spark, sf, "part").where("p_partkey < 100").select(F.col("p_partkey").cast("string").alias("job_id"), F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(cast(p_partkey % 30 as int))").alias("last_modified_at"))


LOG_SQL = """ev AS (SELECT event_id, ts, user_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events),
q AS (SELECT event_id AS query_id, user_id AS talent_key, ts AS query_time,
  array_to_string(list_transform(range(20), lambda i: (k + 7 * i) % 100), ',') AS exposed_jobs FROM ev WHERE event_type = 'view'),
br AS (SELECT user_id AS talent_key, CAST(k AS VARCHAR) AS job_id, ts AS event_time FROM ev WHERE event_type = 'click'),
ap AS (SELECT user_id AS talent_key, CAST(k AS VARCHAR) AS job_id, ts AS event_time FROM ev WHERE event_type = 'purchase'),
b1 AS (SELECT b.*, q.query_id, q.query_time FROM br b ASOF JOIN q ON b.talent_key = q.talent_key AND b.event_time >= q.query_time
  WHERE b.event_time <= q.query_time + INTERVAL 24 HOUR AND list_contains(string_split(q.exposed_jobs, ','), b.job_id)),
a1 AS (SELECT b.*, q.query_id, q.query_time FROM ap b ASOF JOIN q ON b.talent_key = q.talent_key AND b.event_time >= q.query_time
  WHERE b.event_time <= q.query_time + INTERVAL 72 HOUR AND list_contains(string_split(q.exposed_jobs, ','), b.job_id)),
pos AS (SELECT query_id, job_id, max(relevance) AS relevance, bool_or(viewed) AS viewed, bool_or(applied) AS applied FROM (
  SELECT query_id, job_id, 1 AS relevance, true AS viewed, false AS applied FROM b1 UNION ALL
  SELECT query_id, job_id, 2, false, true FROM a1) GROUP BY 1, 2),
ex AS (SELECT query_id, query_time, trim(j) AS job_id, CAST(pos AS INT) AS original_rank FROM (
  SELECT query_id, query_time, unnest(string_split(exposed_jobs, ',')) AS j, generate_subscripts(string_split(exposed_jobs, ','), 1) AS pos FROM q) WHERE trim(j) <> ''),
jobs AS (SELECT CAST(p_partkey AS VARCHAR) AS job_id, TIMESTAMP '2024-01-01' + to_days(CAST(p_partkey % 30 AS INT)) AS last_modified_at FROM part WHERE p_partkey < 100)"""


#: Logical names of the raw job columns of the fixture.
RAW_JOBS = {c: f"raw {c}" for c in ("job_id", "title", "description", "location_code", "duty_minor", "computer_skills", "certifications", "salary_min", "salary_max", "last_modified_at")}


def raw_tables(spark, sf) -> dict[str, DataFrame]:
    """Six tables of texts as they come: blanks, NULL, times that aren't, repeated searches, users without a number."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    e = table(spark, sf, "events").select("event_type", k.alias("k"), (F.col("user_id") % 50).cast("string").alias("talentNo"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))
    shown = F.when(F.col("k") % 13 == 0, " ").otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (F.col("k") + i * 7) % 100), ","))
    once = e.where("event_type = 'view'").select(
        "talentNo", F.when(F.col("k") % 9 == 0, "  ").otherwise(F.format_string(" k%s ", F.col("k") % 20)).alias("ks"), (F.col("k") % 4).cast("string").alias("c0"), (F.col("k") % 5).cast("string").alias("d0"),
        F.when(F.col("k") % 17 == 0, "never").otherwise(F.col("t")).alias("search_time"), shown.alias("empStr"), "k",
    )
    log = lambda kind, job, time: e.where(F.col("event_type") == kind).select("talentNo", F.format_string(" %s", "k").alias(job), F.col("t").alias(time))
    p, n = table(spark, sf, "part"), table(spark, sf, "nation")
    size = F.col("p_size")
    place = p.join(n, F.col("p_partkey") % 30 == F.col("n_nationkey"), "left")
    jobs = place.select(
        F.col("p_partkey").cast("string").alias("job_id"), F.when(size % 7 == 0, "NULL").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("title"), F.when(size % 11 == 0, " ").otherwise(F.col("p_type")).alias("description"),
        F.concat(F.coalesce("n_name", F.lit("Nowhere")), F.lit(" ")).alias("location_code"), F.when(size % 6 == 0, "NULL").when(size % 6 == 1, "odd").otherwise(F.col("p_type")).alias("duty_minor"),
        F.when(size % 3 == 0, F.col("p_brand")).alias("computer_skills"), F.when(size % 4 == 0, "PMP").otherwise("").alias("certifications"), F.when(size % 5 == 0, "much").otherwise(size.cast("string")).alias("salary_min"),
        F.lit(None).cast("string").alias("salary_max"), F.when(size % 8 == 0, "never").otherwise(F.expr("concat('2024-01-', lpad(cast(1 + p_partkey % 30 as string), 2, '0'), ' 00:00:00')")).alias("last_modified_at"),
    )
    name = F.concat("n_name", F.lit(" ")).alias("CodeNameA")
    city = lambda prefix, kind: n.select(F.concat(F.lit(prefix), F.col("n_nationkey").cast("string")).alias("CodeNo"), name, kind.alias("CodeType"))
    duty = lambda n: p.select("p_type").distinct().select(F.substring(F.md5("p_type"), 1, n).alias("CodeNo"), F.col("p_type").alias("CodeNameA"))
    return {
        "search": once.union(once.where("k % 10 = 3")).drop("k"), "browse": log("click", "employeeNo", "dateIn"), "apply": log("purchase", "empNo", "datein"), "jobs": jobs.withColumnsRenamed(RAW_JOBS),
        "cities": city("10", F.when(F.col("n_nationkey") % 2 == 0, "2").otherwise("1")).union(city("9", F.lit("1"))), "duties": duty(4).union(duty(6)),
    }


RAW_SQL = """ev AS (SELECT event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, CAST(user_id % 50 AS VARCHAR) AS talent, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events),
s0 AS (SELECT talent, CASE WHEN k % 9 = 0 THEN '' ELSE 'k' || k % 20 END AS query, CAST(k % 4 AS VARCHAR) AS location_code, CAST(k % 5 AS VARCHAR) AS occupation_code, CASE WHEN k % 17 = 0 THEN NULL ELSE t END AS query_time,
  CASE WHEN k % 13 = 0 THEN '' ELSE array_to_string(list_transform(range(10), lambda i: (k + 7 * i) % 100), ',') END AS exposed, k FROM ev WHERE event_type = 'view'),
rs AS (SELECT * FROM s0 UNION ALL SELECT * FROM s0 WHERE k % 10 = 3),
kq AS (SELECT *, coalesce(nullif(talent, '0'), 'anonymous') AS who FROM rs WHERE query <> '' AND query_time IS NOT NULL),
sq AS (SELECT *, row_number() OVER (PARTITION BY who, query_time, query, location_code, occupation_code, exposed) AS nth FROM kq),
ct AS (SELECT name, code FROM (SELECT trim(n_name) AS name, code, row_number() OVER (PARTITION BY trim(n_name) ORDER BY CASE kind WHEN '2' THEN 0 ELSE 1 END, length(code), code) AS rn FROM (
  SELECT n_name, '10' || n_nationkey AS code, CASE WHEN n_nationkey % 2 = 0 THEN '2' ELSE '1' END AS kind FROM nation UNION ALL SELECT n_name, '9' || n_nationkey, '1' FROM nation)) WHERE rn = 1),
du AS (SELECT DISTINCT p_type AS name, substr(md5(p_type), 1, 6) AS code FROM part),
rj AS (SELECT CAST(p_partkey AS VARCHAR) AS job_id, CASE WHEN p_size % 7 = 0 THEN '' ELSE p_name END AS title, CASE WHEN p_size % 11 = 0 THEN '' ELSE p_type END AS description, coalesce(n_name, 'Nowhere') AS location_name,
  CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN 'odd' ELSE p_type END AS duty_minor, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE '' END AS computer_skills, CASE WHEN p_size % 4 = 0 THEN 'PMP' ELSE '' END AS certifications,
  CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS salary_min, CASE WHEN p_size % 8 = 0 THEN NULL ELSE '2024-01-' || lpad(CAST(1 + p_partkey % 30 AS VARCHAR), 2, '0') || ' 00:00:00' END AS posted_at
  FROM part LEFT JOIN nation ON p_partkey % 30 = n_nationkey)"""


def baskets(spark, sf, dealt: int = 0) -> DataFrame:
    """Skills of jobs: brands of an order's parts, some under another name, some without evidence or with one from elsewhere. `dealt`:
    into so many parts by their jobs, which then meet their orders there."""
    li, part, orders = (table(spark, sf, n) for n in ("lineitem", "part", "orders"))
    level = F.when(F.col("l_returnflag") == "R", "required").when(F.col("l_returnflag") == "A", "preferred").otherwise("mentioned")
    raw = F.when(F.col("l_linenumber") == 3, F.concat(F.lit("Part "), "p_brand")).otherwise(F.col("p_brand"))
    evidence = F.when(F.col("l_partkey") % 97 == 0, "elsewhere").when(F.col("l_partkey") % 101 == 0, "").otherwise(raw)
    rows = li.join(part, li.l_partkey == part.p_partkey)
    if dealt:
        rows, orders = rows.repartition(dealt, "l_orderkey"), orders.repartition(dealt, "o_orderkey")
    return rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("job_id"), F.col("p_brand").alias("skill"), F.col("p_type").alias("skill_type"), F.col("o_orderpriority").alias("occupation_code"),
        level.alias("requirement"), F.lit(0.9).alias("importance"), (1 - F.col("l_tax")).alias("confidence"), raw.alias("raw_mention"), evidence.alias("evidence"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted_at"), F.col("l_linenumber").alias("pos"),
    )


def stored_baskets(spark, sf, *leave: str) -> DataFrame:
    """The baskets in a table bucketed by job, made with one shuffle; without the columns `leave`."""
    n = G.job_buckets(spark, table(spark, sf, "lineitem").count())
    return G.by_job(baskets(spark, sf, n).drop(*leave), n)


def order_jobs(spark, sf) -> DataFrame:
    """Orders as jobs: what INSTANCE_OF edges need."""
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_orderpriority").alias("occupation_code"))


def basket_jobs(spark, sf, js: DataFrame | None = None) -> DataFrame:
    """Orders as jobs with their texts; the requirements are the names of the parts. `js`: the baskets, if they are stored."""
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "raw_mention"))), lambda x: x["raw_mention"]), ", ")
    texts = (baskets(spark, sf) if js is None else js).groupBy("job_id").agg(listed.alias("requirements"))
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.concat("o_orderpriority", F.lit(" job")).alias("title"), F.concat(F.lit("Order of "), F.col("o_custkey").cast("string")).alias("description"),
        F.col("o_orderstatus").alias("location_code"), F.col("o_orderpriority").alias("occupation_code"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted_at"), F.lit("train").alias("data_split"),
    )
    return o.join(texts, "job_id", "left").na.fill("", ["requirements"])


_SKILL = "'skill:' || substr(sha256(lower(skill) || '|' || skill_type), 1, 16)"
_ALIAS = "'alias:' || substr(sha256(lower(raw_mention)), 1, 16)"
BASKETS_SQL = """js AS (SELECT *, CASE WHEN part_key % 97 = 0 THEN 'elsewhere' WHEN part_key % 101 = 0 THEN '' ELSE raw_mention END AS evidence FROM (
  SELECT l_orderkey AS job_id, p_brand AS skill, p_type AS skill_type, o_orderpriority AS occupation_code, l_partkey AS part_key, l_linenumber AS pos,
  CASE l_returnflag WHEN 'R' THEN 'required' WHEN 'A' THEN 'preferred' ELSE 'mentioned' END AS requirement, 0.9::DOUBLE AS importance, 1 - l_tax AS confidence,
  CASE WHEN l_linenumber = 3 THEN 'Part ' || p_brand ELSE p_brand END AS raw_mention, strftime(o_orderdate, '%Y-%m-%d') AS posted_at
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)),
jb AS (SELECT o_orderkey AS job_id, o_orderpriority || ' job' AS title, coalesce(requirements, '') AS requirements, 'Order of ' || o_custkey AS description, o_orderpriority AS occupation_code,
  strftime(o_orderdate, '%Y-%m-%d') AS posted_at FROM orders LEFT JOIN (SELECT job_id, string_agg(raw_mention, ', ' ORDER BY pos, raw_mention) AS requirements FROM js GROUP BY 1) ON job_id = o_orderkey)"""

NODE_COLUMNS = ("node_id", "label", "name", "occupation_code", "posted_at", "data_split", "source_hash", "normalized_alias", "first_seen_at", "normalized_name", "skill_type", "train_frequency")
NODES_SQL = f"""n AS (
  SELECT 'job:' || job_id AS node_id, 'Job' AS label, CAST(job_id AS VARCHAR) AS job_id, occupation_code, posted_at, 'train' AS data_split,
    sha256('{{"description":"' || description || '","requirements":"' || requirements || '","title":"' || title || '"}}') AS source_hash FROM jb
  UNION ALL BY NAME SELECT DISTINCT 'occupation:' || trim(occupation_code) AS node_id, 'Occupation' AS label, trim(occupation_code) AS name, trim(occupation_code) AS occupation_code FROM jb
  UNION ALL BY NAME SELECT {_SKILL} AS node_id, 'Skill' AS label, skill AS name, lower(skill) AS normalized_name, skill_type, min(posted_at) AS first_seen_at, count(DISTINCT job_id) AS train_frequency FROM js GROUP BY skill, skill_type
  UNION ALL BY NAME SELECT DISTINCT 'category:' || lower(skill_type) AS node_id, 'SkillCategory' AS label, skill_type AS name FROM js
  UNION ALL BY NAME SELECT DISTINCT ON (raw_mention) {_ALIAS} AS node_id, 'SkillAlias' AS label, raw_mention AS name, lower(raw_mention) AS normalized_alias, min(posted_at) OVER (PARTITION BY raw_mention) AS first_seen_at
    FROM js WHERE lower(raw_mention) <> lower(skill))"""

EDGES_SQL = f"""e0 AS (
  SELECT 'job:' || job_id AS from_id, skill AS to_id, CASE requirement WHEN 'required' THEN 'REQUIRES' WHEN 'preferred' THEN 'PREFERS' ELSE 'MENTIONS' END AS label,
    (CASE requirement WHEN 'required' THEN 1.0 WHEN 'preferred' THEN 0.72 ELSE 0.45 END)::DOUBLE * m.i * m.c AS weight, m.c AS confidence, m.e AS evidence, CAST(job_id AS VARCHAR) AS source_job_id, m.r AS raw_mention, job_id || ':' || raw AS origin
    FROM (SELECT job_id, {_SKILL} AS skill, requirement, lower(raw_mention) AS raw, max({{'i': importance, 'c': confidence, 'e': evidence, 'r': raw_mention}}) AS m FROM js GROUP BY 1, 2, 3, 4)
  UNION ALL SELECT 'job:' || job_id, 'occupation:' || trim(occupation_code), 'INSTANCE_OF', 1.0, 1.0, trim(occupation_code), CAST(job_id AS VARCHAR), NULL, CAST(job_id AS VARCHAR) FROM jb
  UNION ALL SELECT DISTINCT {_SKILL}, 'category:' || lower(skill_type), 'IS_A', 1.0, 1.0, skill_type, '', NULL, skill_type FROM js
  UNION ALL SELECT alias, skill, 'ALIAS_OF', 1.0, m.c, m.e, CAST(m.j AS VARCHAR), NULL, raw
    FROM (SELECT {_ALIAS} AS alias, {_SKILL} AS skill, lower(raw_mention) AS raw, min({{'j': job_id, 'c': confidence, 'e': evidence}}) AS m FROM js WHERE lower(raw_mention) <> lower(skill) GROUP BY 1, 2, 3)),
e AS (SELECT substr(sha256(from_id || '|' || label || '|' || to_id || '|' || origin), 1, 20) AS edge_id, * EXCLUDE (origin) FROM e0)"""

#: Rows with one fault each. Skills are of two kinds of alias; jobs are written out.
BAD_NODE = "node_id string, label string, name string, skill_type string, normalized_name string, data_split string, job_id string"
BAD_NODES = [
    ("dup", "Job", None, None, None, "train", "d"), ("dup", "Job", None, None, None, "train", "d"), ("odd", "Planet", "p", None, None, None, None), ("orphan", "Skill", "lonely", "t", "lonely", None, None),
    ("late", "Job", None, None, None, "test", "l"), ("s1", "Skill", "Java", "Language", "java", None, None), ("s2", "Skill", "JavaScript", "Language", "javascript", None, None),
    ("s3", "Skill", "java", "Beverage", "java", None, None), ("al1", "SkillAlias", "JavaScript", None, None, None, None), ("al2", "SkillAlias", "js", None, None, None, None),
    ("al3", "SkillAlias", "ecma", None, None, None, None), ("al4", "SkillAlias", "es", None, None, None, None), ("j1", "Job", None, None, None, "train", "x"),
]
BAD_EDGE = "edge_id string, from_id string, to_id string, label string, weight double, confidence double, evidence string, source_job_id string, data_split string, count long, npmi double"
BAD_EDGES = [
    ("e1", "j1", "s1", "REQUIRES", 0.5, 1.5, "Java", "0", None, None, None), ("e2", "j1", "s1", "PREFERS", 1.5, 0.5, "", "0", None, None, None), ("e2", "j1", "s2", "PREFERS", 0.5, 0.5, "Rust", "none", None, None, None),
    ("e4", "j1", "gone", "MENTIONS", 0.5, 0.5, "Java", "0", None, None, None), ("e5", "s1", "j1", "REQUIRES", None, 0.5, "Java", "0", "test", None, None), ("e6", "s1", "s2", "CO_OCCURS_WITH", 0.2, 1.0, "x", "", None, 2, 0.5),
    ("e7", "al1", "s1", "ALIAS_OF", 1.0, 1.0, None, "0", None, None, None), ("e8", "al1", "s2", "ALIAS_OF", 1.0, 1.0, "js", "0", None, None, None), ("e9", "al2", "al3", "ALIAS_OF", 1.0, 1.0, "js", "0", None, None, None),
    ("e10", "al3", "al4", "ALIAS_OF", 1.0, 1.0, "js", "0", None, None, None), ("e11", "al4", "al2", "ALIAS_OF", 1.0, 0.2, "js", "0", None, None, None), ("e12", "s1", "s2", "LIKES", 1.0, 1.0, "x", " ", None, None, None),
    ("e13", "s3", "j1", "LIKES", -0.1, 1.0, "x", "", None, None, None), ("e14", "s2", "s3", "CO_OCCURS_WITH", 0.0, 1.0, "x", "", None, 7, 0.05),
]
#: More than the built graph has: the columns that lack are findings.
MORE_PROPERTIES = {"Skill": ("skill_id", "embedding"), "Planet": ("mass",), "Job": ("job_id",), "Comet": ("tail",)}


def faulty_graph(spark, sf) -> C.Graph:
    """The graph of the baskets as it is built, and rows with faults."""
    js = stored_baskets(spark, sf)
    jobs, known = basket_jobs(spark, sf, js), G.names(js)
    n = G.nodes(jobs, js, known=known).unionByName(spark.createDataFrame(BAD_NODES, BAD_NODE), allowMissingColumns=True)
    e = G.edges(order_jobs(spark, sf), js, known=known, dealt=True).unionByName(spark.createDataFrame(BAD_EDGES, BAD_EDGE), allowMissingColumns=True)
    source = jobs.select(F.col("job_id").cast("string").alias("job_id"), "title", "requirements", "description").union(spark.createDataFrame([("0", "", "Java only", "")], "job_id string, title string, requirements string, description string"))
    known = {k: v for k, v in MORE_PROPERTIES.items() if k != "Planet"}
    labels = {**{k: () for k in G.NODE_LABELS}, **known}
    rules = C.Rules(node_properties=labels, edge_properties=("weight", "reviewed_by"), protected=(("java", "javascript"),))
    audit = js.select(F.when(F.col("pos") != 7, F.col("skill")).alias("selected"))
    return C.Graph(n, e, source, audit, rules)


def _values(rows) -> str:
    one = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else repr(x)
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


_names = lambda schema: ", ".join(f'"{c.split()[0]}"' for c in schema.split(", "))
FAULTY_SQL = f"""{BASKETS_SQL}, {NODES_SQL}, {EDGES_SQL},
fn AS (SELECT * FROM n UNION ALL BY NAME SELECT * FROM (VALUES {_values(BAD_NODES)}) AS t({_names(BAD_NODE)})),
fe AS (SELECT * FROM e UNION ALL BY NAME SELECT * FROM (VALUES {_values(BAD_EDGES)}) AS t({_names(BAD_EDGE)})),
src AS (SELECT CAST(job_id AS VARCHAR) AS job_id, concat_ws(chr(10), title, requirements, description) AS body FROM jb UNION ALL SELECT '0', chr(10) || 'Java only' || chr(10)),
ids AS (SELECT node_id, min(label) AS l, coalesce(min(name), '') AS nm FROM fn GROUP BY 1),
ends AS (SELECT fe.*, f.l AS from_label, f.nm AS from_name, t.l AS to_label, t.nm AS to_name FROM fe JOIN ids f ON from_id = f.node_id JOIN ids t ON to_id = t.node_id),
sk AS (SELECT * FROM fe WHERE label IN ('REQUIRES', 'PREFERS', 'MENTIONS'))"""


def corpus_queries(spark, sf) -> DataFrame:
    """Queries from the first six tokens of benchmark texts."""
    b = table(spark, sf, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.slice(T.latin_tokens(F.col("text")), 1, 6).alias("terms"))


TERMS_SQL = """qt AS (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[a-z0-9+#.]+')[1:6]) AS term FROM benchmark),
qa AS (SELECT query_id, term, count(*) AS times FROM qt GROUP BY 1, 2),
dt AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9+#.]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY 1, 2),
len AS (SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9+#.]+')) AS length FROM documents),
st AS (SELECT count(*) AS n, greatest(avg(length), 1.0) AS avg_length FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)"""


def ranked_lists(spark, sf) -> DataFrame:
    """Documents of a source as the results of a query; two scores."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    return d.join(l, "doc_id").select(
        F.col("source").alias("query_id"), F.col("doc_id").alias("job_id"), (F.col("quality") + 1 - F.col("toxic")).cast("int").alias("relevance"),
        F.col("n_chars").cast("double").alias("score_a"), ((F.col("doc_id") * 7919) % 1009).cast("double").alias("score_b"), F.length("text").cast("double").alias("length"),
    )


RANKED_SQL = """rl AS (SELECT source AS query_id, doc_id AS job_id, CAST(quality + 1 - toxic AS INT) AS relevance, CAST(n_chars AS DOUBLE) AS score_a,
  CAST((doc_id * 7919) % 1009 AS DOUBLE) AS score_b FROM documents JOIN labels USING (doc_id))"""


def metrics_sql(score: str, name: str) -> str:
    return f"""{name}_r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {score} DESC, job_id) AS place,
  row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, job_id) AS ideal FROM rl),
{name}_s AS (SELECT query_id, sum(CASE WHEN place <= 10 THEN (pow(2, relevance) - 1) / log2(place + 1) ELSE 0 END) AS dcg,
  sum(CASE WHEN ideal <= 10 THEN (pow(2, relevance) - 1) / log2(ideal + 1) ELSE 0 END) AS idcg,
  count(*) FILTER (relevance > 0 AND place <= 10) / 10.0 AS precision, max(CASE WHEN place = 1 AND relevance > 0 THEN 1.0 ELSE 0.0 END) AS top1,
  min(place) FILTER (relevance > 0) AS first FROM {name}_r GROUP BY 1),
{name} AS (SELECT query_id, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS ndcg, precision, top1, coalesce(1.0 / first, 0) AS mrr,
  CASE WHEN first <= 10 THEN 1.0 ELSE 0.0 END AS hit FROM {name}_s)"""
