"""Byte-level BPE by dynamic programming over prefixes, exact to the public tokenizers' merges."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the public byte-level format: how text is split before merging.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+",
    regex.V0,
)
#: Pieces whose ids each worker remembers, and the longest of them; a bound on memory, not on results.
REMEMBERED, SHORT = 400_000, 48


def byte_letters() -> dict[str, int]:
    """The letter by which the format writes each byte: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder for one vocabulary file (its JSON text)."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters = byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        vocab = {raw(t): i for t, i in data["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        #: left << 20 | right -> rank of their merge; and of each token the rank of its merge (bytes: -1) and its halves.
        self.merge: dict[int, int] = {}
        self.rank = [-1] * (1 + max(self.bytes_of))
        self.left, self.right = list(self.rank), list(self.rank)
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.merge[a << 20 | b] = rank
            if self.rank[c] < 0:
                self.rank[c], self.left[c], self.right[c] = rank, a, b
        #: Tokens by their bytes as Latin-1 letters; ids that the merges can really reach.
        self.whole: dict[str, int] = {}
        self.matches = ahocorasick.Automaton()
        self.fits: dict[int, bool] = {}
        for token, i in vocab.items():
            if self.reachable(i):
                self.whole[token.decode("latin-1")] = i
                self.matches.add_word(token.decode("latin-1"), (len(token), i))
        self.matches.make_automaton()
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, tuple[int, ...]] = {}

    def reachable(self, token: int) -> bool:
        """Whether encoding the token's own bytes gives the token."""
        rank, left, right = self.rank[token], self.left[token], self.right[token]
        return rank < 0 or (self.reachable(left) and self.reachable(right) and self.stays(left, right, rank))

    def stays(self, a: int, b: int, below: int | None = None) -> bool:
        """Whether merging leaves the border between two adjacent tokens alone (up to the merge of rank `below`).

        Take both tokens apart from their last merge backwards. Whenever the tokens that face each other across the
        border could be merged, that merge must come too late: after the facing token on the left was used up by its
        own merge (same rank: the left one goes first), or after the one on the right was used up by an earlier merge.
        """
        merge, rank = self.merge, self.rank
        by_left = by_right = len(merge) if below is None else below - 1  # ranks at which the facing tokens are used up
        by_left += below is not None
        while True:
            m = merge.get(a << 20 | b)
            if m is not None and m < by_left and m <= by_right:
                return False
            if rank[a] >= rank[b]:
                if rank[a] < 0:
                    return True
                by_left, a = rank[a], self.right[a]
            else:
                by_right, b = rank[b], self.left[b]

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece (its bytes as Latin-1 letters). For each prefix there is one token that its encoding ends
        with: the one among the tokens that are suffixes of the prefix which starts it, or fits behind the last token
        of the prefix before. The automaton names the suffixes, longest first; back-pointers then give the ids."""
        if (one := self.whole.get(text)) is not None:
            return (one,)
        last: list[int] = [-1] * (len(text) + 1)
        size = [0] * (len(text) + 1)
        fits, stays = self.fits, self.stays
        for end, (length, token) in self.matches.iter(text):
            if last[end + 1] >= 0:
                continue
            start = end + 1 - length
            if start:
                before = last[start]
                key = before << 20 | token
                ok = fits.get(key)
                if ok is None:
                    ok = fits[key] = stays(before, token)
                if not ok:
                    continue
            last[end + 1], size[end + 1] = token, length
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= size[at]
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for m in self.cut.finditer(text) if self.cut else ():
            self._plain(text[at : m.start()], out)
            out.append(self.special[m[0]])
            at = m.end()
        self._plain(text[at:] if at else text, out)
        return out

    def _plain(self, text: str, out: list[int]) -> None:
        known = self.known
        for p in SPLIT.findall(text):
            ids = known.get(p)
            if ids is None:
                ids = self.piece(p.encode().decode("latin-1"))
                if len(p) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[p] = ids
                if len(self.fits) > 4 * REMEMBERED:
                    self.fits.clear()
            out += ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    """One codec for each vocabulary and worker process."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _codecs:
        _codecs[name] = Codec(spec)
    return _codecs[name]


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the ids of each whole text, as the tokenizers library gives them without added special tokens;
    special tokens' strings inside a text are those tokens. The vocabulary file is read on the driver and broadcast:
    a public file of a few MB that doesn't grow with the data. Null texts are empty and give no ids; null and
    repeated keys are rows like others; very long texts are encoded whole, one in memory at a time besides its Arrow batch;
    an empty table gives no rows; other columns are ignored."""
    spec = docs.sparkSession.sparkContext.broadcast(_spec(path))

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(spec.value)
        for batch in it:
            ids = [code.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        batches, "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(doc_id, text) from ids; broken UTF-8 becomes U+FFFD, null ids an empty text."""
    spec = encoded.sparkSession.sparkContext.broadcast(_spec(path))

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(spec.value)
        for batch in it:
            texts = [code.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(batches, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row: encode, decode the ids, and digest both, in one
    pass over the texts without a shuffle. Defined for awkward rows as `encode`."""
    spec = docs.sparkSession.sparkContext.broadcast(_spec(path))

    def batches(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(spec.value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in it:
            n, of_ids, of_text = [], [], []
            for t in batch.column(1):
                ids = code.encode(t.as_py() or "")
                n.append(len(ids))
                of_ids.append(sha(",".join(map(str, ids)).encode()))
                of_text.append(sha(code.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        batches, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
