"""Merkle manifest of a dataset: a root over all rows, and for each row the proof that it belongs to it.

A leaf is the digest of a row.  The leaves of a source ascend by doc_id; while
there are several nodes, every 16 consecutive ones become the digest of their
digests.  The roots of the sources, in order of the source, form a tree of the
same kind.

A node's rank, written with base 16, tells its place on every level: the digits
are grouped away one after the other, each time into an array of structs that
nests the children's.  A block of 256 nodes is rolled up that way in one
shuffle; its root is a node of the next round, so a round has 1/256 of the rows
of the one before and a source with most of the rows is spread over many
blocks.  On the way down each block's array is transformed (every child gets
the digests to its left and right) and exploded, level by level, so the proofs
need no join of leaves with nodes.

Defined cases: a null column is a value of its own; a null doc_id comes before
all others and isn't tampered with; rows of one doc_id stand in order of their
leaves; equal rows have proofs of their own; an empty table has no proofs;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalspark.session import fits_broadcast, materialize, written_and_counted

WIDTH = 16
DIGITS = 2                      # of a block: 256 nodes
BLOCK = WIDTH ** DIGITS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
MOST_CELLS = 1_000_000          # rows of a broadcast table of counts, whose bytes are measured as well
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- leaves --------------------------------------------------------------------------------------------------------------

def row_digest(text: Column | None = None) -> Column:
    """Digest of a row's fields; ``text`` stands for the column of that name."""
    parts = []
    for name in FIELDS:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """doc_id, source, leaf and claimed of every row: the digest that the row shows to a verifier, null where it is the
    leaf.  Written once; the texts are read nowhere else."""
    docs = docs.select(FIELDS)
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    return materialize(docs.select("doc_id", "source", row_digest().alias("leaf"), claimed.alias("claimed"),
                                   F.monotonically_increasing_id().alias("row")), "manifest-leaves")


def tampered() -> Column:
    """The digest of the row with its text's A-Z lower-cased where 5 divides crc32(doc_id), else null."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, row_digest(F.translate("text", _UPPER, _LOWER)))


# ---- ranks ---------------------------------------------------------------------------------------------------------------

def ranked(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with r, their rank from 0 in the group, and n, the group's size; and the largest n.  ``order`` must tell
    all rows of a group apart.

    Rows are dealt out by ranges of (group, order), so a large group is split; a row's rank is its place in its range
    after what earlier ranges hold of the group.  Those counts have a row a range and one a group."""
    spark = rows.sparkSession
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    placed = materialize(rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
                         .withColumn("place", F.monotonically_increasing_id()).withColumn("range", F.shiftright("place", 33)), "manifest-order")
    each = Window.partitionBy(group)
    cells = placed.groupBy(group, "range").agg(F.count(F.lit(1)).alias("here"), F.min("place").alias("first"))
    cells = cells.select(F.col(group).alias("cell_group"), F.col("range").alias("cell_range"), F.sum("here").over(each).alias("n"),
                         (F.sum("here").over(each.orderBy("range")) - F.col("here") - F.col("first")).alias("shift"))
    cells, count, size = written_and_counted(cells, "manifest-cells")
    largest = cells.agg(F.max("n")).first()[0] or 0
    cells = F.broadcast(cells) if fits_broadcast(count, size, MOST_CELLS) else cells.hint("merge")
    out = placed.join(cells, (F.col("range") == F.col("cell_range")) & F.col(group).eqNullSafe(F.col("cell_group")))
    return out.select(*rows.columns, (F.col("place") + F.col("shift")).alias("r"), "n"), largest


# ---- up ------------------------------------------------------------------------------------------------------------------

def roll(nodes: DataFrame) -> DataFrame:
    """g, r, n, h, kids: the blocks of nodes (g, r, n, h, load), each with its root and its nodes nested by digits.

    n is the group's number of nodes; a level that starts with a single node has no digest of its own."""
    digit = [F.expr(f"int(r div {WIDTH ** k} % {WIDTH})").alias(f"d{k}") for k in range(DIGITS)]
    t = nodes.select("g", "n", F.expr(f"r div {BLOCK}").alias("block"), *digit, "h", F.col("load").alias("kids")).repartition("g", "block")
    for k in range(DIGITS):
        keys = ["g", "n", "block", *[f"d{j}" for j in range(k + 1, DIGITS)]]
        t = t.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("d"), "h", "kids"))).alias("kids"))
        t = t.withColumn("h", F.when(F.col("n") > WIDTH ** k, F.sha2(F.concat_ws("", "kids.h"), 256)).otherwise(F.col("kids")[0]["h"]))
    return t.select("g", F.col("block").alias("r"), "n", "h", "kids")


def roll_up(nodes: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all rounds, and the root (g, h) of every group."""
    rounds = []
    while True:
        rounds.append(materialize(roll(nodes), "manifest-blocks"))
        nodes = rounds[-1].select("g", "r", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), "h", F.lit(None).cast("int").alias("load"))
        largest = -(-largest // BLOCK)
        if largest <= 1:
            return rounds, nodes.select("g", "h")


# ---- down ----------------------------------------------------------------------------------------------------------------

PATH = "array<struct<left:string,right:string>>"


def unroll(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """g, r, h, load, path, top of the blocks' nodes, from the paths of the blocks (g, r, path, top).

    A block meets its own path by grouping; then each array is transformed and exploded."""
    none = lambda table, name: F.lit(None).cast(table.schema[name].dataType).alias(name)
    both = (blocks.select("g", "r", "n", "kids", none(above, "path"), none(above, "top"))
            .unionByName(above.select("g", "r", F.lit(None).cast("long").alias("n"), none(blocks, "kids"), "path", "top")))
    t = both.groupBy("g", "r").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "top")])
    for k in reversed(range(DIGITS)):
        def beside(kid, i):
            every = F.col("kids.h")
            return F.struct(kid["d"].alias("d"), kid["h"].alias("h"), kid["kids"].alias("kids"),
                            F.concat_ws("", F.slice(every, 1, i)).alias("left"), F.concat_ws("", F.slice(every, i + 2, WIDTH)).alias("right"))
        t = t.select("g", "r", "n", "path", "top", F.explode(F.transform("kids", beside)).alias("kid"))
        step = F.array(F.struct("kid.left", "kid.right")).cast(PATH)
        t = t.select("g", (F.col("r") * WIDTH + F.col("kid.d")).alias("r"), "n", F.col("kid.h").alias("h"), F.col("kid.kids").alias("kids"), "top",
                     F.when(F.col("n") > WIDTH ** k, F.concat(step, F.col("path"))).otherwise(F.col("path")).alias("path"))
    return t.select("g", "r", "h", F.col("kids").alias("load"), "path", "top")


def proofs(rows: DataFrame) -> DataFrame:
    """doc_id, leaf, claimed, subroot, root and path of every row of ``leaves``: path has for each level, from the leaf to
    the root, the digests to the left and right of the node (concatenated)."""
    nodes, largest = ranked(rows, "source", ["doc_id", "leaf", "row"])
    rounds, subroots = roll_up(nodes.select(F.col("source").alias("g"), "r", "n", F.col("leaf").alias("h"), F.struct("doc_id", "claimed").alias("load")),
                               largest)
    sources, count = ranked(subroots.select(F.lit(0).alias("all"), F.col("g").alias("source"), F.col("h").alias("subroot")), "all", ["source"])
    upper, root = roll_up(sources.select(F.col("all").alias("g"), "r", "n", F.col("subroot").alias("h"), F.struct("source").alias("load")), count)
    down = root.select("g", F.lit(0).cast("long").alias("r"), F.array().cast(PATH).alias("path"), F.col("h").alias("top"))
    for blocks in reversed(upper):
        down = unroll(blocks, down)
    down = down.select(F.col("load.source").alias("g"), F.lit(0).cast("long").alias("r"), "path", F.struct(F.col("h").alias("subroot"), F.col("top").alias("root")).alias("top"))
    for blocks in reversed(rounds):
        down = unroll(blocks, down)
    return down.select("load.doc_id", F.col("h").alias("leaf"), "load.claimed", "top.subroot", "top.root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside its path lead to."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all digests of a path, from the leaf's siblings to those below the root."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"]))), 256)


def verify(proved: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from the claimed leaf), verified."""
    folded = proved.withColumn("folded_root", fold(F.coalesce("claimed", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify(proofs(leaves(spark.read.parquet(f"{sf_dir}/documents.parquet"), tampered())))


# ---- SQL -----------------------------------------------------------------------------------------------------------------

def _levels(name: str, group: str, height: int) -> str:
    """CTEs of a tree over name0 (group, r, n, h): for each level its nodes with the digests to their left and right."""
    out = []
    for k in range(height + 1):
        run = f"PARTITION BY {group}, r // {WIDTH} ORDER BY r ROWS BETWEEN"
        out.append(f"""{name}{k}p AS (SELECT *, n > 1 AS used,
            coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS t FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT {group}, r // {WIDTH} AS r, (max(n) + {WIDTH - 1}) // {WIDTH} AS n,
            CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE max(h) END AS h FROM {name}{k} GROUP BY {group}, r // {WIDTH})""")
    return ",\n".join(out)


def _sql(height: int = 5, upper: int = 3) -> str:
    """Enough levels for 16^6 rows a source and 16^4 sources."""
    def field(name, value=None):
        value = value or f"CAST({name} AS VARCHAR)"
        return f"coalesce(concat(strlen({value}), ':', {value}), '-')"
    fields = [field(c) for c in FIELDS[:-1]]
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    crc = ("xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)), "
           "lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)::UBIGINT[]), lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT)")
    steps = [("d", k, f"d{k}p", "d.source IS NOT DISTINCT FROM x{}.source AND x{}.r = d.r // " + str(WIDTH ** k)) for k in range(height + 1)]
    steps += [("s", k, f"s{k}p", "x{}.r = u.r // " + str(WIDTH ** k)) for k in range(upper + 1)]
    joins, folds, proof = "", "coalesce(d.claimed, d.leaf)", []
    for i, (_, _, table, on) in enumerate(steps):
        joins += f" JOIN {table} x{i} ON " + on.replace("{}", str(i))
        proof.append(f"CASE WHEN x{i}.used THEN x{i}.l || x{i}.t ELSE '' END")
    chain = f"f0 AS (SELECT d.*, u.subroot, (SELECT max(h) FROM s{upper + 1}) AS root, {folds} AS f, sha256({' || '.join(proof)}) AS proof_sha256, "
    chain += ", ".join(f"x{i}.used AS u{i}, x{i}.l AS l{i}, x{i}.t AS t{i}" for i in range(len(steps)))
    chain += f" FROM leaves d JOIN u ON u.source IS NOT DISTINCT FROM d.source{joins})"
    for i in range(len(steps)):
        chain += f",\nf{i + 1} AS (SELECT * REPLACE (CASE WHEN u{i} THEN sha256(l{i} || f || t{i}) ELSE f END AS f) FROM f{i})"
    return f"""
WITH hashed AS (
    SELECT doc_id, source, sha256({' || '.join([*fields, field('text')])}) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN sha256({' || '.join([*fields, field('text', lower)])}) END AS claimed
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM hashed),
d0 AS (SELECT source, r, n, leaf AS h FROM leaves),
{_levels('d', 'source', height)},
u AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM d{height + 1}),
s0 AS (SELECT 0 AS g, r, n, subroot AS h FROM u),
{_levels('s', 'g', upper)},
{chain}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(steps)}
"""


ORACLE_SQL = _sql()
