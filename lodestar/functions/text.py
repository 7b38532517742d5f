"""Text functions as Column expressions; Python only where Unicode normalisation has no built-in."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

HAN = r"[\x{3400}-\x{9fff}]"


def trimmed(c: Column) -> Column:
    """Trim all Unicode spaces, but no tabs."""
    return F.regexp_replace(c, r"^\p{Zs}+|\p{Zs}+$", "")


def clean(c: Column) -> Column:
    """Trim; blanks and the word NULL become null."""
    t = trimmed(c.cast("string"))
    return F.when(~t.isin("", "NULL"), t)


@F.pandas_udf(StringType())
def _folded(values: pd.Series) -> pd.Series:
    def fold(v):
        if v is None:
            return None
        v = unicodedata.normalize("NFKC", v).translate(str.maketrans("，。＃", ",.#"))
        return " ".join(v.split()).casefold()

    return values.map(fold)


@F.pandas_udf(StringType())
def _shown(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v).strip())


def _ascii_or(c: Column, fast: Column, slow) -> Column:
    """Plain ASCII stays in the JVM; the other rows go through Arrow."""
    plain = F.octet_length(c) == F.length(c)
    return F.coalesce(F.when(plain, fast), slow(F.when(~plain, c)))


def normalise(c: Column) -> Column:
    """NFKC, wide punctuation to ASCII, white space collapsed and trimmed, case folded; keeps + # and dots."""
    return _ascii_or(c, F.lower(F.trim(F.regexp_replace(c, r"[\s\x1c-\x1f]+", " "))), _folded)


def display_name(c: Column) -> Column:
    return _ascii_or(c, F.regexp_replace(c, r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""), _shown)


def latin_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"([a-z0-9+#.]+)"), F.lit(1))


def tokens(c: Column) -> Column:
    """Latin tokens, then single Han characters."""
    return F.concat(latin_tokens(c), F.regexp_extract_all(c, F.lit(f"({HAN})"), F.lit(1)))


def _grams(run: Column, n: int) -> Column:
    starts = F.when(F.length(run) >= n, F.sequence(F.lit(1), F.length(run) - (n - 1)))
    return F.coalesce(F.transform(starts, lambda i: F.substr(run, i, F.lit(n))), F.array().cast("array<string>"))


def search_tokens(c: Column, most: int = 2500) -> Column:
    """Terms of an indexed text: Latin runs of two or more, and uni-, bi- and trigrams of Han runs; ordered, distinct."""
    body = F.substring(normalise(c), 1, most)
    latin = F.regexp_extract_all(body, F.lit(r"([a-z0-9+#.]{2,})"), F.lit(1))
    han = F.regexp_extract_all(body, F.lit(f"({HAN}+)"), F.lit(1))
    grams = F.flatten(F.transform(han, lambda r: F.concat(_grams(r, 1), _grams(r, 2), _grams(r, 3))))
    return F.array_distinct(F.concat(latin, grams))


def query_terms(c: Column, most: int = 500) -> Column:
    """Terms of a query: Han runs of up to two characters whole, longer ones as trigrams only."""
    body = F.substring(normalise(c), 1, most)
    latin = F.regexp_extract_all(body, F.lit(r"([a-z0-9+#.]{2,})"), F.lit(1))
    han = F.regexp_extract_all(body, F.lit(f"({HAN}+)"), F.lit(1))
    grams = F.flatten(F.transform(han, lambda r: F.when(F.length(r) <= 2, F.array(r)).otherwise(_grams(r, 3))))
    return F.array_distinct(F.concat(latin, grams))


@F.pandas_udf(StringType())
def _plain(values: pd.Series) -> pd.Series:
    def strip(v):
        return None if v is None else "".join(x for x in unicodedata.normalize("NFKD", v) if not unicodedata.combining(x))

    return values.map(strip)


def fts_parts(term: Column) -> Column:
    """The parts of a term as full-text engines index it: without marks on letters, cut where there is no letter or digit. So
    + # and dots part a term; a term of several parts is a phrase."""
    return F.regexp_extract_all(_ascii_or(F.lower(term), F.lower(term), _plain), F.lit(r"([\p{L}\p{N}\p{Co}]+)"), F.lit(1))


def has_phrase(parts: Column, phrase: Column) -> Column:
    """Whether the parts of a phrase stand side by side in the parts of a text."""
    n = F.size(phrase)
    starts = F.when(F.size(parts) >= n, F.sequence(F.lit(1), F.size(parts) - n + 1)).otherwise(F.array().cast("array<int>"))
    return (n > 0) & F.exists(starts, lambda i: F.slice(parts, i, n) == phrase)


#: Values of a multi-value field that say nothing. Fixed values.
IGNORED = ("", "null", "none", "無", "不拘", "其他", "略")


def split_values(c: Column, ignored: Sequence[str] = IGNORED) -> Column:
    """A multi-value field: cut at commas, semicolons (wide ones too) and line ends, white space collapsed, 1 to 120
    characters, ordered, distinct, without ignored words."""
    parts = F.transform(F.split(c, "[,，;；\n\r]+"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    keep = F.filter(parts, lambda p: F.length(p).between(1, 120) & ~F.lower(F.translate(p, "ＮＯＵＬＥｎｏｕｌｅ", "NOULEnoule")).isin(*ignored, ""))
    return F.array_distinct(F.coalesce(keep, F.array().cast("array<string>")))


def overlap(query: Column, document: Column) -> Column:
    """Share of the query's distinct tokens that the document has; 0 without tokens on either side."""
    n = F.size(F.array_distinct(query))
    return F.coalesce(F.when(n > 0, F.size(F.array_intersect(query, document)) / n), F.lit(0.0))


def digest_id(prefix: str, *parts: Column, width: int = 16) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, width))


def query_id(*parts: Column) -> Column:
    return F.concat(F.lit("q_"), F.substring(F.md5(F.concat_ws("|", *parts)), 1, 20))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def repaired_json(c: Column) -> Column:
    """From the first { to the last }, so without byte order mark and fences, and without trailing commas; empty if
    there is no object."""
    body = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.regexp_replace(body, r",\s*([}\]])", "$1")


def hash_embedding(c: Column, dim: int = 32) -> Column:
    """Sum over tokens of their SHA-256 bytes (cyclic), scaled to [-1, 1], then to length 1; a text
    without tokens is one itself."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"((?U)[\w.+#-]+)"), F.lit(1))
    toks = F.when(F.size(words) > 0, words).otherwise(F.array(F.lower(c)))
    digests = F.transform(toks, lambda t: F.sha2(t, 256))
    byte = lambda d, i: F.conv(F.substr(d, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("double")
    sums = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.aggregate(digests, F.lit(0.0), lambda s, d: s + (byte(d, i) / 127.5 - 1)),
    )
    norm = F.sqrt(F.aggregate(sums, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(sums, lambda x: x / norm)).otherwise(sums)


@F.pandas_udf(ArrayType(DoubleType()))
def signed_hash_embedding(values: pd.Series) -> pd.Series:
    """256 slots; each byte of each token's SHA-256 adds 1 or -1, by parity, at slot (31 i + byte) mod 256."""
    import hashlib

    import numpy as np

    def embed(v):
        out = np.zeros(256)
        for t in (v or "").lower().split():
            for i, b in enumerate(hashlib.sha256(t.encode()).digest()):
                out[(31 * i + b) % 256] += 1.0 if b % 2 == 0 else -1.0
        norm = np.sqrt(out @ out)
        return (out / norm if norm else out).tolist()

    return values.map(embed)
