"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary is a rank file (base64 bytes and rank a line).  A library that
works on ranks merges any two neighbours whose bytes together have the lowest
rank; the tokenizers library merges listed pairs.  So all ways to cut a token
into two tokens are listed, in order of the token's rank; where two cuts of a
token can meet in one text (x|y and y|z), the one that would stand left comes
first, as the leftmost of equal ranks is merged first.  A match that is itself
a token is taken whole (``ignore_merges``).

Defined cases: a null text is empty and has no ids; an empty text has no ids;
special tokens' strings are ordinary text; repeated rows are encoded like any
others; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vitalspark.llm.arrow_text import PieceEncoder, by_bytes, ragged, slices, trim


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if it is
    printable in Latin-1 and not a space, else the next free one from U+0100 on."""
    out, free = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 255 and b != 173:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _cuts(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The places where the token can be cut into two tokens, in the order in which to try them."""
    at = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    n = len(token)
    # x|y stands left of y|z when the right part of one cut is the left part of the other
    first = {i: {n - i} if n - i in at and token[i:] == token[:n - i] and n - i != i else set() for i in at}
    out: list[int] = []

    def put(i: int, seen: tuple = ()) -> None:
        if i not in out and i not in seen:
            for j in at:
                if i in first[j] and j not in first[i]:
                    put(j, (*seen, i))
            out.append(i)

    for i in at:
        put(i)
    return out


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """The rank file as a tokenizers definition, to be handed to the workers."""
    chars = byte_characters()
    spell = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [[spell[t[:i]], spell[t[i:]]] for t in sorted(ranks, key=ranks.get) if len(t) > 1 for i in _cuts(t, ranks)]
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}]},
        "post_processor": None, "decoder": None,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                  "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                  "vocab": {spell[t]: r for t, r in ranks.items()}, "merges": merges}})


class ByteTable:
    """Ids to bytes and back to character places."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for t, r in ranks.items():
            tokens[r] = t
        self.length = np.fromiter(map(len, tokens), np.int64, size)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The exact bytes of the ids."""
        return ragged(self.bytes, self.start[ids], self.length[ids]).tobytes()

    def decode_parts(self, parts) -> Iterator[str]:
        """Text of a stream of id arrays; a character split between tokens or parts comes with the part
        that completes it, bytes that form none become U+FFFD."""
        import codecs
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in parts:
            yield decoder.decode(self.decode(np.asarray(ids, np.int64)))
        yield decoder.decode(b"", final=True)

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last character that each token touches: a token that holds part of a
        character's bytes counts the whole character."""
        text = np.frombuffer(self.decode(ids), np.uint8)
        lead = np.concatenate([np.zeros(1, np.int64), np.cumsum((text & 0xC0) != 0x80)])
        end = np.cumsum(self.length[ids])
        start = end - self.length[ids]
        return lead[start + 1] - 1, lead[end]


SLICE = 1 << 20             # bytes of text that are encoded at once
KEEP_BYTES = 12 << 20       # of pieces that a worker keeps; ids and digests of a slice take room beside them


def _worker(spec: str, rank_path: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tk = Tokenizer.from_str(spec)
    return PieceEncoder(tk, KEEP_BYTES), ByteTable(read_ranks(rank_path))


_workers: dict[str, tuple] = {}


def encode(docs: DataFrame, rank_path: str, pattern: str, ids: bool = True, offsets: bool = False, digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and, of each whole text: with ``ids`` the ids (array<int>), with ``offsets`` char_start
    and char_end of each token, with ``digest`` ids_sha256 and decoded_sha256 (of the bytes decoded from them)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json(read_ranks(rank_path), pattern))  # size: the vocabulary's
    lists = pa.list_(pa.int32())

    def run(batches):
        if rank_path not in _workers:
            _workers[rank_path] = _worker(shared.value, rank_path)
            trim(forget=False)      # reading the definition takes several times its size
        encoder, table = _workers[rank_path]
        for batch in batches:
            for s in slices(batch.column(1), max_bytes=SLICE):
                flat, at = encoder.encode(s)
                rows = [flat[at[i]:at[i + 1]] for i in range(s.n)]
                out = [batch.column(0).slice(s.first, s.n).cast(pa.int64()), pa.array(np.diff(at), pa.int64())]
                ends = pa.array(at, pa.int32())
                if ids:
                    out.append(pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())))
                if offsets:
                    spans = [table.offsets(r) for r in rows]
                    out += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[k] for x in spans]), pa.int32())) for k in (0, 1)]
                if digest:
                    out += [pa.array([hashlib.sha256(",".join(map(str, r.tolist())).encode()).hexdigest() for r in rows], pa.string()),
                            pa.array([hashlib.sha256(table.decode(r)).hexdigest() for r in rows], pa.string())]
                yield pa.record_batch(out, names=names)
                flat = rows = out = None
                trim(forget=False)      # what a slice has freed, else it adds up over the slices
        trim(forget=False)

    names = ["doc_id", "n_tokens"] + ["ids"] * ids + ["char_start", "char_end"] * offsets + ["ids_sha256", "decoded_sha256"] * digest
    kinds = {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    schema = ", ".join(f"{n} {kinds.get(n, 'array<int>')}" for n in names)
    return by_bytes(docs.select("doc_id", "text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, rank_path: str) -> DataFrame:
    """doc_id and text of rows with ids; bytes that form no character become U+FFFD; null ids give null."""
    def run(batches):
        table = ByteTable(read_ranks(rank_path))
        for batch in batches:
            texts = [None if ids is None else table.decode(np.asarray(ids, np.int64)).decode("utf-8", "replace")
                     for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=False, digest=True)
