"""Token ids in a canonical, length-limited Huffman file.

Ids are counted over the whole corpus; package-merge gives the shortest code
with no word over LIMIT bits, canonical order makes its lengths the whole code
book.  The file is a Parquet table of blocks in ascending doc_id order.  A
block holds whole documents, up to BLOCK_TOKENS ids or one longer document; it
decodes without any other block, and every STRIDE ids it notes a bit offset,
so a block is decoded in many lanes at once, one table lookup an id.

Files: ``blocks`` (part, seq, offset: ids of the part before the block, docs
and counts: int64, payload, marks: uint64 bit offsets) and ``codebook`` (id,
bits).

Defined cases: a null text is empty; the string of an added token in a text is
that token, as the library has it by default; every document ends with the end
id, so an empty one has one id; rows of one doc_id stand side by side, ordered by
length and hash; a null doc_id comes first; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspark.llm.arrow_text import ENCODE_BYTES, PieceEncoder, by_bytes, slices, trim, trimmed
from vitalspark.session import work_path

LIMIT = 18
BLOCK_TOKENS = 1 << 18
STRIDE = 256
BATCH = "8m"                # bytes of texts or ids at once, two slices to encode
END_ID = 2
U = np.uint64


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id's code word, 0 for ids that don't occur (package-merge)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    lists, current = [], leaves
    is_package = np.zeros(len(leaves), bool)
    for _ in range(limit - 1):
        lists.append(is_package)
        even = len(current) // 2 * 2
        packages = current[0:even:2] + current[1:even:2]
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        current, is_package = both[rank], rank >= len(leaves)
    lists.append(is_package)
    take, bits = 2 * len(leaves) - 2, np.zeros(len(leaves) + 1, np.int64)
    for packed in reversed(lists):
        n = int(packed[:take].sum())
        bits[0] += 1
        bits[take - n] -= 1      # the first take - n leaves are in this list
        take = 2 * n
    out[order] = np.cumsum(bits)[:-1]
    return out


def code_words(lengths: np.ndarray) -> np.ndarray:
    """Canonical words: by length, then id."""
    words, order = np.zeros(len(lengths), U), np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code, before = 0, 0
    by_length = np.bincount(lengths[order], minlength=1)
    first = {}
    for n in range(1, len(by_length)):
        code = (code + before) << 1
        first[n], before = code, int(by_length[n])
    place = np.arange(len(order)) - np.concatenate([[0], np.cumsum(by_length)])[lengths[order]]
    words[order] = np.array([first[n] for n in lengths[order].tolist()], U) + place.astype(U)
    return words


def encode_bits(ids: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string of the ids (most significant bit first, in 32-bit big-endian words) and the bit offset
    of every STRIDE-th id."""
    n = lengths[ids].astype(np.int64)
    if not len(n):
        return b"", np.zeros(0, np.uint64)
    at = np.cumsum(n) - n
    total = int(at[-1] + n[-1])
    value = words[ids] << (64 - (at & 31) - n).astype(U)
    word = at >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))    # no code word is over 32 bits, so each 32 bits start one
    out = np.zeros(int(word[-1]) + 2, U)
    out[:-1] = np.add.reduceat(value >> U(32), first)
    out[1:] += np.add.reduceat(value & U(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[:-(-total // 8)], at[::STRIDE].astype(np.uint64)


class Decoder:
    def __init__(self, lengths: np.ndarray):
        self.bits = max(1, int(lengths.max(initial=1)))
        words = code_words(lengths)
        self.table = np.zeros(1 << self.bits, np.uint32)      # id * 32 + bits
        used = np.flatnonzero(lengths)
        order = used[np.argsort(words[used] << (self.bits - lengths[used].astype(np.int64)).astype(U), kind="stable")]
        spread = 1 << (self.bits - lengths[order].astype(np.int64))
        filled = np.repeat((order.astype(np.uint32) << 5) | lengths[order], spread)
        self.table[:len(filled)] = filled

    def decode(self, payload: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        """n ids; all lanes between marks go on by one id at a time."""
        data = np.frombuffer(payload + b"\0" * 8, np.uint8)
        wide = np.zeros(len(data) - 4, U)      # the 40 bits from each byte on
        for k in range(5):
            wide = (wide << U(8)) | data[k:len(data) - 4 + k]
        out = np.zeros((STRIDE, len(marks)), np.uint32)
        at, shift, mask = marks.astype(np.int64), 40 - self.bits, (1 << self.bits) - 1
        last = len(wide) - 1
        for k in range(STRIDE):
            b = np.minimum(at >> 3, last)     # the last lane may run on past the end; what it reads there is cut off
            found = self.table[(wide[b] >> (shift - (at & 7)).astype(U)).view(np.int64) & mask]
            out[k] = found >> np.uint32(5)
            at += found & np.uint32(31)
        return out.T.reshape(-1)[:n]


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens and ids (uint16 or uint32, little-endian) of each whole text with the end id; and a row a task
    that has counts alone: how often each id occurs in the task's texts (int64)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())    # size: the vocabulary's
    kind = id_kind(tokenizer_path)

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        if tokenizer_path not in _encoders:
            _encoders[tokenizer_path] = PieceEncoder(Tokenizer.from_str(spec.value))
        encoder, counts = _encoders[tokenizer_path], np.zeros(0, np.int64)
        for batch in batches:
            for s in slices(batch.column(1), max_bytes=ENCODE_BYTES):
                ids, at = encoder.encode(s)
                ids = np.insert(ids, at[1:], end_id).astype(kind)
                counts = _added(counts, np.bincount(ids))
                at = at + np.arange(s.n + 1)
                size = np.dtype(kind).itemsize
                yield pa.record_batch([
                    batch.column(0).slice(s.first, s.n).cast(pa.int64()), pa.array(np.diff(at), pa.int64()),
                    pa.Array.from_buffers(pa.binary(), s.n, [None, pa.py_buffer((at * size).astype(np.int32)), pa.py_buffer(ids)]),
                    pa.nulls(s.n, pa.binary())], names=names)
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                               pa.array([counts.tobytes()], pa.binary())], names=names)
        trim(forget=False)      # the pieces serve the next task too; the steps after this one forget them

    names = ["doc_id", "n_tokens", "ids", "counts"]
    return by_bytes(docs.select("doc_id", "text"), BATCH).mapInArrow(run, "doc_id long, n_tokens long, ids binary, counts binary")


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of two arrays, the shorter one filled up with 0."""
    if len(a) < len(b):
        a, b = b, a
    out = a.astype(np.int64)
    out[:len(b)] += b
    return out


_encoders: dict[str, PieceEncoder] = {}


def id_kind(tokenizer_path: str) -> str:
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def count_ids(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in the whole corpus: the tasks' counts, summed in Spark, as long as the vocabulary."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total = _added(total, np.frombuffer(x.as_buffer(), np.int64))
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    rows = (tokens.select("counts").where("counts IS NOT NULL").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(int(rows.id.max()) + 1 if len(rows) else 1, np.int64)
    out[rows.id.to_numpy(np.int64)] = rows.n.to_numpy(np.int64)
    return out


def write_token_file(tokens: DataFrame, kind: str, path: str, parts: int) -> None:
    """Write the blocks and the code book of a written table of ``tokenize`` below ``path``."""
    spark = tokens.sparkSession
    counts = count_ids(tokens)
    tokens = tokens.where("n_tokens IS NOT NULL")
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used] or [], "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    book = spark.sparkContext.broadcast(lengths)

    def run(batches):
        from pyspark import TaskContext
        part, seq, offset = TaskContext.get().partitionId(), 0, 0
        words = code_words(book.value)
        docs, ids = [], []

        def block():
            nonlocal seq, offset, docs, ids
            counts = np.array([len(x) for x in ids], np.int64)
            payload, marks = encode_bits(np.concatenate(ids), words, book.value)
            row = [part, seq, offset, int(counts.sum()), docs, counts.tolist(), payload, marks.tobytes()]
            seq, offset, docs, ids = seq + 1, offset + row[3], [], []
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, types)], names=names)

        held = 0
        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(x.as_buffer(), kind)
                if ids and held + len(x) > BLOCK_TOKENS:
                    yield block()
                    held = 0
                docs.append(doc)
                ids.append(x)
                held += len(x)
        if ids:
            yield block()

    names = ["part", "seq", "offset", "n_tokens", "docs", "counts", "payload", "marks"]
    longs = pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), longs, longs, pa.binary(), pa.binary()]
    (tokens.withColumn("tie", F.xxhash64("ids"))
     .repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "tie")
     .select("doc_id", "ids")
     .mapInArrow(trimmed(run), "part int, seq int, offset long, n_tokens long, docs array<long>, counts array<long>, payload binary, marks binary")
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone."""
    book = spark.read.parquet(f"{path}/codebook").toPandas()     # as long as the vocabulary
    lengths = np.zeros(int(book.id.max()) + 1 if len(book) else 1, np.uint8)
    lengths[book.id.to_numpy(np.int64)] = book.bits.to_numpy(np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).toPandas().sort_values("part")    # one row a file
    base = dict(zip(totals.part.tolist(), (totals.n.cumsum() - totals.n).tolist()))
    shared = spark.sparkContext.broadcast((lengths, base))

    def run(batches):
        decoder = Decoder(shared.value[0])
        for batch in batches:
            for r in range(batch.num_rows):
                part, offset, n = (batch.column(k)[r].as_py() for k in (0, 1, 2))
                counts = np.asarray(batch.column(4)[r].values, np.int64)
                ids = decoder.decode(batch.column(5)[r].as_py(), np.frombuffer(batch.column(6)[r].as_py(), np.uint64), n).astype("<u4")
                ends = np.cumsum(counts)
                starts = ends - counts
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.record_batch([batch.column(3)[r].values, pa.array(shared.value[1][part] + offset + starts, pa.int64()),
                                       pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (blocks.select("part", "offset", "n_tokens", "docs", "counts", "payload", "marks")
            .mapInArrow(trimmed(run), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op2_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = work_path(spark, "token-ids")     # written once, for the counts and the file
    tokenize(spark.read.parquet(f"{sf_dir}/documents.parquet"), path).write.option("compression", "zstd").parquet(ids)
    tokens = spark.read.parquet(ids)
    out = work_path(spark, "token-file")
    write_token_file(tokens, id_kind(path), out, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_token_file(spark, out)
