"""Token counts: greedy longest-match word pieces counted by an automaton, without building pieces.

The vocabulary has pieces that begin a word and pieces that continue one.  Both
are put into one byte trie under two roots.  Every node knows how many pieces
longest-match takes off its string when no child fits (``pops``) and the node
of what is left (``fail``, the continuation root or a node below it); so each
byte is read once and a word's count is the sum of the pops on its way, linear
in its length.  Tasks run all different words of a slice through the automaton
side by side, one byte of all words a step.

A rank file gives the vocabulary: tokens with a leading space begin words (the
space is dropped), tokens without continue them; tokens with white space
elsewhere play no part.  A word is a run without ASCII white space, as it
stands; one that longest-match can't cut up wholly counts as one unknown token.

Defined cases: a null, empty or white text has no words and no tokens; repeated
rows are counted like others; null ids stay; words of any length are read
whole; other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vitalspark.llm.arrow_text import IS_SPACE, Slice, row_sums, slices, span_ids
from vitalspark.llm.bpe import read_ranks

LONG = 256      # words over so many bytes are read one by one
DEAD = -1


def vocabulary(rank_path: str) -> tuple[set[bytes], set[bytes]]:
    """(pieces that begin a word, pieces that continue one)."""
    white = {b for b in range(256) if IS_SPACE[b]}
    begin, go_on = set(), set()
    for t in read_ranks(rank_path):
        body = t[1:] if t[:1] == b" " else t
        if body and not white & set(body):
            (begin if t[:1] == b" " else go_on).add(body)
    return begin, go_on


class Automaton:
    """Nodes 0 (word's begin) and 1 (continuation) are the roots.  Children are kept in a hash table of (node, byte)."""

    def __init__(self, begin: set[bytes], go_on: set[bytes]):
        child: dict[int, int] = {}
        parent, byte, is_piece = [DEAD, DEAD], [0, 0], [False, False]
        level: list[list[int]] = [[]]
        for root, pieces in ((0, begin), (1, go_on)):
            for piece in sorted(pieces):
                v = root
                for depth, c in enumerate(piece):
                    key = v << 8 | c
                    if key not in child:
                        child[key] = len(parent)
                        parent.append(v)
                        byte.append(c)
                        is_piece.append(False)
                        while len(level) <= depth + 1:
                            level.append([])
                        level[depth + 1].append(child[key])
                    v = child[key]
                is_piece[v] = True
        fail, pops = [DEAD] * len(parent), [0] * len(parent)
        for nodes in level[1:]:
            for v in nodes:
                if is_piece[v]:
                    fail[v], pops[v] = 1, 1
                    continue
                u, c = parent[v], byte[v]
                z, n = fail[u], pops[u]
                while z != DEAD and (z << 8 | c) not in child:
                    n += pops[z]
                    z = fail[z]
                if z != DEAD:
                    fail[v], pops[v] = child[z << 8 | c], n
        self.fail, self.pops = np.array(fail, np.int32), np.array(pops, np.int32)
        key = np.fromiter(child, np.int64, len(child))
        node = np.fromiter(child.values(), np.int32, len(child))
        size = 1 << max(4, int(len(child) * 3).bit_length())
        self.mask, self.key, self.node = size - 1, np.full(size, -1, np.int64), np.full(size, DEAD, np.int32)
        slot, left = self._slot(key), np.arange(len(key))
        while len(left):
            free = left[self.key[slot[left]] < 0]
            at, first = np.unique(slot[free], return_index=True)
            self.key[at], self.node[at] = key[free[first]], node[free[first]]
            left = left[self.key[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * 0x9E3779B1) >> 7) & self.mask

    def children(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node by each byte, or DEAD."""
        key = node.astype(np.int64) << 8 | byte
        slot = self._slot(key)
        out = np.full(len(key), DEAD, np.int32)
        left = np.arange(len(key))
        while len(left):
            at = slot[left]
            have = self.key[at]
            hit = have == key[left]
            out[left[hit]] = self.node[at[hit]]
            on = ~hit & (have >= 0)
            left = left[on]
            slot[left] = (at[on] + 1) & self.mask
        return out

    def counts(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word buf[start:end], 0 for unknown ones."""
        size = ends - starts
        order = np.argsort(-size, kind="stable")
        out = np.zeros(len(starts), np.int64)
        long = int(np.searchsorted(-size[order], -LONG, "left"))
        for i in order[:long]:
            out[i] = self.count(buf[starts[i]:ends[i]].tobytes())
        order = order[long:]
        at, size = starts[order], size[order]
        node, total = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        alive = np.ones(len(order), bool)
        for step in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -step, "left"))      # words longer than step stand first
            lanes = np.flatnonzero(alive[:n])
            while len(lanes):
                to = self.children(node[lanes], buf[at[lanes] + step])
                found = to != DEAD
                node[lanes[found]] = to[found]
                lanes = self._fall(lanes[~found], node, total, alive)
        lanes = np.flatnonzero(alive & (node != 1))
        while len(lanes):
            lanes = self._fall(lanes, node, total, alive)
            lanes = lanes[node[lanes] != 1]
        out[order] = np.where(alive, total, 0)
        return out

    def _fall(self, lanes, node, total, alive) -> np.ndarray:
        """Take the failure link of each lane; those that go on."""
        to = self.fail[node[lanes]]
        dead = to == DEAD
        alive[lanes[dead]] = False
        lanes, to = lanes[~dead], to[~dead]
        total[lanes] += self.pops[node[lanes]]
        node[lanes] = to
        return lanes

    def count(self, word: bytes) -> int:
        """Pieces of one word, 0 if it is unknown."""
        child, fail, pops = self._plain()
        v, total = 0, 0
        for c in word:
            while (to := child.get(v << 8 | c)) is None:
                if fail[v] == DEAD:
                    return 0
                total += pops[v]
                v = fail[v]
            v = to
        while v != 1:
            if fail[v] == DEAD:
                return 0
            total += pops[v]
            v = fail[v]
        return total

    def _plain(self):
        if not hasattr(self, "plain"):
            used = self.key >= 0
            self.plain = dict(zip(self.key[used].tolist(), self.node[used].tolist())), self.fail.tolist(), self.pops.tolist()
        return self.plain


def count_slice(automaton: Automaton, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, tokens and unknown words of each row; each different word is counted once."""
    starts, ends, at = s.words()
    number, different = span_ids(s.buf, starts, ends)
    where = np.zeros(len(different), np.int64)
    where[number[::-1]] = np.arange(len(number))[::-1]
    n = automaton.counts(s.buf, starts[where], ends[where])[number]
    return np.diff(at), row_sums(np.maximum(n, 1), at), row_sums((n == 0).astype(np.int64), at)


def count_tokens(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every whole text; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(automaton))      # size: the vocabulary's

    def run(batches):
        own = pickle.loads(shared.value)
        for batch in batches:
            for s in slices(batch.column(1)):
                columns = count_slice(own, s)
                yield pa.record_batch([batch.column(0).slice(s.first, s.n).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in columns]],
                                      names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op8_wordpiece_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    automaton = Automaton(*vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), automaton)
