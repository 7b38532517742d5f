"""Extraction and embedding by pluggable providers: retries, a response cache, dead letters. No network here."""

from __future__ import annotations

import hashlib
import json
import random
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.sources.shared import materialise


#: The version goes into each request, so a new wording has other cache keys. The field names are those of the records.
PROMPT_VERSION = "skills-2"
RULES = (
    "Name only skills that the text itself mentions; copy raw_mention and evidence from it letter by letter.",
    "evidence is the shortest passage that shows the skill and how it is asked for.",
    "requirement is required, preferred or mentioned; where the text doesn't say, it is mentioned.",
    "importance and confidence are numbers from 0 to 1.",
    "canonical_candidate is the usual name of the skill; don't merge skills that only resemble each other.",
    "Answer with one JSON object and nothing else, without fields that the schema lacks.",
)


def record_schema() -> str:
    """The shape of an answer, as it is written into the request."""
    from lodestar.operators.extraction import SKILL_TYPES

    skill = {
        "raw_mention": "text", "canonical_candidate": "text", "skill_type": " | ".join(SKILL_TYPES), "requirement": "required | preferred | mentioned", "importance": "number", "confidence": "number",
        "evidence": "text", "start_char": "integer or null", "end_char": "integer or null",
    }
    return json.dumps({"job_id": "text", "occupation_candidate": "text or null", "extraction_prompt_version": PROMPT_VERSION, "skills": [skill]})


def prompt(title: str = "title", requirements: str = "requirements", description: str = "description", key: str = "job_id"):
    """The request text of a job as a column: task and version, rules, the shape of the answer, the job."""
    part = lambda n, c: F.concat(F.lit(f"{n}: "), F.coalesce(F.col(c).cast("string"), F.lit("")))
    head = [f"Find the skills that a job posting asks for. Version {PROMPT_VERSION}.", *(f"{i}. {r}" for i, r in enumerate(RULES, 1)), f"Schema: {record_schema()}"]
    return F.concat_ws("\n", F.lit("\n".join(head)), part("JOB_ID", key), part("TITLE", title), part("REQUIREMENTS", requirements), part("DESCRIPTION", description))


def request_body(prompt_text, most_tokens: int = 4096, temperature: float = 0.0):
    """The request as JSON, a column: one message of the user."""
    message = F.struct(F.lit("user").alias("role"), prompt_text.alias("content"))
    return F.to_json(F.struct(F.lit(most_tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"), F.array(message).alias("messages")))


def requests(jobs: DataFrame) -> DataFrame:
    """(job_id, key, body): what would be asked of a provider; nothing is sent."""
    text = prompt()
    return jobs.select("job_id", cache_key(text).alias("key"), request_body(text).alias("body"))


def unwrapped(response):
    """The text that a provider's response holds, a column: a record itself, the text of its first message (in either of two
    places), its body, or the response if it is no JSON object; null for objects of other shapes."""
    at = lambda path: F.get_json_object(response, path)
    is_record = at("$.job_id").isNotNull() & at("$.skills").isNotNull() & at("$.extraction_prompt_version").isNotNull()
    inner = F.coalesce(at("$.output.message.content[0].text"), at("$.content[0].text"), F.when(F.try_variant_get(F.try_parse_json(response), "$.body", "string").isNotNull(), at("$.body")))
    return F.when(F.json_object_keys(response).isNull() | is_record, response).otherwise(inner)


def with_retry(call: Callable[[str], str], text: str, attempts: int = 3, base: float = 1.0, most: float = 30.0, sleep=time.sleep) -> str:
    """Exponential waits with jitter between attempts; the last error is raised."""
    for i in range(attempts):
        try:
            return call(text)
        except Exception:
            if i == attempts - 1:
                raise
            sleep(min(most, base * 2**i) * (0.5 + random.random() / 2))
    raise ValueError("attempts must be positive")


def cache_key(body):
    return F.sha2(body, 256)


def extract(jobs: DataFrame, call: Callable[[str], str], cache: DataFrame | None = None, attempts: int = 3, keep: str | None = None) -> DataFrame:
    """(job_id, key, body, error) for each job: from the cache (key, body) where it has the request, else from the
    provider, called in tasks, once for equal requests. Answers are stored before they are used, so that none is asked for
    again, and added to the table at `keep`, the next run's cache. Failures keep their message and can go to a dead-letter table."""
    rows = jobs.select("job_id", prompt().alias("text")).withColumn("key", cache_key(F.col("text")))
    had = cache.groupBy("key").agg(F.first("body").alias("body")) if cache is not None else None
    rest = rows.join(had, "key", "left_anti") if cache is not None else rows

    def run(it: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in it:
            out = []
            for key, text in zip(pdf["key"], pdf["text"]):
                try:
                    out.append((key, with_retry(call, text, attempts), None))
                except Exception as e:  # kept as a dead letter
                    out.append((key, None, str(e)[:500]))
            yield pd.DataFrame(out, columns=["key", "body", "error"])

    fresh = materialise(rest.groupBy("key").agg(F.first("text").alias("text")).mapInPandas(run, "key string, body string, error string"))
    if keep:
        fresh.where("error is null").select("key", "body").write.mode("append").parquet(keep)
    answers = fresh if had is None else fresh.unionByName(had.withColumn("error", F.lit(None).cast("string")))
    return rows.select(F.col("job_id").cast("string").alias("job_id"), "key").join(answers, "key").select("job_id", "key", "body", "error")


def mock(responses: dict[str, str]) -> Callable[[str], str]:
    """A provider that answers by the job id in the request."""

    def call(text: str) -> str:
        job = text.split("JOB_ID: ", 1)[1].split("\n", 1)[0]
        return responses[job]

    return call


def import_plan(nodes: str, edges: str, allow: bool = False) -> dict:
    """What a graph store's bulk load would take; nothing is executed."""
    if allow:
        raise NotImplementedError("the plan is never executed here")
    return {"dry_run": True, "sources": [nodes, edges], "format": "csv", "id": hashlib.sha256(f"{nodes}|{edges}".encode()).hexdigest()[:16]}


def skill_text():
    return F.array_join(F.filter(F.array(*(F.coalesce(F.col(c), F.lit("")) for c in ("canonical_name", "skill_type", "description"))), lambda x: x != ""), " | ")


def occupation_text():
    return F.array_join(F.filter(F.array(*(F.coalesce(F.col(c), F.lit("")) for c in ("name", "occupation_code", "description"))), lambda x: x != ""), " | ")


def embed(nodes: DataFrame, provider: Callable, model: str = "hash", dimension: int = 32) -> DataFrame:
    """node_id, label, embedding_text, embedding, embedding_model, embedding_dimension of skills and occupations, by a
    Column function such as functions.text.hash_embedding. A vector of another length is an error where it is read."""
    text = F.when(F.col("label") == "Skill", skill_text()).otherwise(occupation_text())
    rows = nodes.where(F.col("label").isin("Skill", "Occupation")).select("node_id", "label", text.alias("embedding_text"))
    made = rows.withColumn("embedding", provider(F.col("embedding_text")))
    fits = F.size("embedding") == dimension
    checked = F.when(fits, F.col("embedding")).otherwise(F.raise_error(F.lit(f"a vector has not {dimension} components")).cast(made.schema["embedding"].dataType))
    return made.select("node_id", "label", "embedding_text", checked.alias("embedding"), F.lit(model).alias("embedding_model"), F.lit(dimension).alias("embedding_dimension"))


def embedding_manifest(vectors: DataFrame, model: str = "hash", dimension: int = 32) -> DataFrame:
    """One row; the hash is of the sum of the ids' hashes, so no order is needed."""
    sums = F.sum(F.xxhash64("node_id").cast("decimal(38,0)")).cast("string")
    return vectors.agg(F.lit(model).alias("model_id"), F.lit(dimension).alias("dimension"), F.count(F.lit(1)).alias("row_count"), F.sha2(F.coalesce(sums, F.lit("")), 256).alias("node_ids_hash"))


def dead_letters(extracted: DataFrame, path: str) -> None:
    """Failed requests (job_id, key, error), appended as JSON lines."""
    extracted.where("error is not null").select("job_id", "key", "error").write.mode("append").json(path)
