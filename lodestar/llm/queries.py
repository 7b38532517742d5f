"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe, hnsw, licences, lm, mixing, phrases, quality, ranked, resampling, sharding, simhash, token_counts, vector_dedup
from lodestar.llm.tables import materialise


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_docs(spark, sf_dir), vocabulary())


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return quality.score(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_docs(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_docs(spark, sf_dir), vocabulary())


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_docs(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, sf_dir))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_docs(spark, sf_dir))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_docs(spark, sf_dir), _items(spark, sf_dir)).select("doc_id", "n_features", "weight", "score", "rank")


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_docs(spark, sf_dir), _items(spark, sf_dir))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.contamination(materialise(phrases.index(_docs(spark, sf_dir))), _items(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_mixing,
        op2_nearest,
        op3_bpe,
        op4_quality,
        op5_sharding,
        op6_token_counts,
        op7_licences,
        op8_simhash,
        op9_lm,
        op10_vector_dedup,
        op11_resampling,
        op12_ranked,
        op13_phrases,
    )
    return {f.__name__: f for f in every}


def _crc_table() -> list[int]:
    out = list(range(256))
    for _ in range(8):
        out = [c >> 1 ^ (0xEDB88320 if c & 1 else 0) for c in out]
    return out


ORACLE_OP5 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
  lambda a, b: xor(a >> 8, {_crc_table()}[xor(a & 255, b) + 1]))) AS text_crc32 FROM d),
s AS (SELECT doc_id, text_crc32, md5(text) AS m, CAST(strlen(text) + 8 AS BIGINT) AS size FROM c),
p AS (SELECT *, row_number() OVER w - 1 AS position, sum(size) OVER w - size AS start, sum(size) OVER () AS total FROM s WINDOW w AS (ORDER BY m, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, CAST(start * 24 // total AS INT) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, position - min(position) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INT) AS grown_shard, position FROM k"""

#: All pairs; components by the smallest vector that is reached.
ORACLE_OP10 = """WITH RECURSIVE x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM x),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_inner_product(a.v, b.v) / (a.n * b.n) >= 0.95),
r(vec_id, root) AS (SELECT vec_id, vec_id FROM x UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id WHERE r.root < l.b),
c AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY 1), k AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN k USING (vec_id)"""


#: Words of both tables; A-Z alone are lower-cased.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws"
_TEXTS = f"d AS (SELECT doc_id, {_WORDS} FROM documents), i AS (SELECT item_id, {_WORDS} FROM benchmark)"

ORACLE_OP11 = f"""WITH {_TEXTS}, dw AS (SELECT doc_id, unnest(ws) AS w FROM d), iw AS (SELECT unnest(ws) AS w FROM i),
v AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM iw)),
c AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
  lambda a, b: xor(a >> 8, {_crc_table()}[xor(a & 255, b) + 1]))) % 10000 AS bucket FROM v),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN c USING (w) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM iw JOIN c USING (w) GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM iw) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM c) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
f AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM dw JOIN c USING (w) JOIN g USING (bucket) GROUP BY 1),
w AS (SELECT d.doc_id, len(ws)::BIGINT AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight, ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN f USING (doc_id)),
x AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score FROM w),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE n_features >= 20)
SELECT x.*, rank FROM x LEFT JOIN (SELECT * FROM r WHERE rank <= (SELECT count(*) * 10 // 100 FROM r)) USING (doc_id)"""

ORACLE_OP12 = f"""WITH {_TEXTS}, tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM d) GROUP BY 1, 2), s AS (SELECT count(*) AS N, sum(len(ws))::BIGINT AS L FROM d WHERE len(ws) > 0),
m AS (SELECT doc_id, 75 + (25 * len(ws) * N) // L AS m FROM d, s WHERE len(ws) > 0),
w AS (SELECT term, CAST(floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), s),
q AS (SELECT item_id, unnest(ws) AS term FROM i),
sc AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""

ORACLE_OP13 = f"""WITH {_TEXTS}, p AS (SELECT item_id, ws, least(len(ws), 10) AS k FROM i WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id::VARCHAR AS item_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda a: array_to_string(ws[a : a + k - 1], ' '))) AS g FROM p),
o AS (SELECT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda a: {{'a': a, 'g': array_to_string(ws[a : a + k - 1], ' ')}})) AS o FROM d, (SELECT DISTINCT k FROM w) WHERE len(ws) >= k),
h AS (SELECT doc_id, item_id, o.k, o.o.a AS a FROM o JOIN w ON o.k = w.k AND o.o.g = w.g),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + k)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """The others have no SQL: draws, graph searches, vocabularies, trained models and XXH64 are tested against brute force instead."""
    return {"op5_sharding": ORACLE_OP5, "op10_vector_dedup": ORACLE_OP10, "op11_resampling": ORACLE_OP11, "op12_ranked": ORACLE_OP12, "op13_phrases": ORACLE_OP13}
