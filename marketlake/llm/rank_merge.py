"""Token counts by rank-synchronous merging: no token strings are built, only symbols are counted."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from marketlake.llm.common import text_slices

_NONE = np.int64(1) << 40
SPACE = "▁"
#: A pre-token: marks of spaces with what follows them. No piece of the vocabulary reaches over such a border.
PRETOKEN = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: Pre-tokens whose counts a task remembers; beyond it the memory starts anew.
MEMORY = 600_000


class PairTable:
    """Pairs of pieces that merge, with their rank, looked up for whole arrays.

    A pair merges when the two pieces put together are a piece; its rank is the place of that piece in the order of
    falling score. Pieces of equal score share a rank; `tied` marks those ranks.
    """

    def __init__(self, pieces: list[str], scores: list[float]):
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece crosses the border of two pre-tokens")
        ids = {p: i for i, p in enumerate(pieces)}
        order = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        self.char = np.full(0x110000, -1, np.int64)
        pairs = {}
        for p, i in ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = (i, order[scores[i]])
        # One slot a pair where its hash is free; the few others are in a sorted list.
        self.keys = np.full(1 << 21, -1, np.int64)
        self.merged = np.full(len(self.keys), -1, np.int64)
        self.rank = np.full(len(self.keys), _NONE)
        late = []
        keys = np.array(sorted(pairs), np.int64)
        for k, slot in zip(keys.tolist(), self._slot(keys).tolist(), strict=True):
            if self.keys[slot] >= 0:
                late.append((k, *pairs[k]))
            else:
                self.keys[slot], (self.merged[slot], self.rank[slot]) = k, pairs[k]
        late = np.array([*late, ((1 << 62), -1, _NONE)], np.int64)
        self.late = late[:, 0], late[:, 1], late[:, 2]
        self.crowded = np.zeros(len(self.keys), bool)
        self.crowded[self._slot(late[:-1, 0])] = True
        used = np.bincount([order[s] for s in scores])
        self.tied = used > 1

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or _NONE) and merged piece of each pair."""
        key = left << 20 | right  # negative if either is unknown
        slot = self._slot(key)
        hit = (self.keys[slot] == key) & (key >= 0)
        rank, merged = np.where(hit, self.rank[slot], _NONE), self.merged[slot]
        if len(more := np.flatnonzero(~hit & self.crowded[slot])):
            keys, pieces, ranks = self.late
            at = np.searchsorted(keys, key[more])
            at[at == len(keys)] = 0
            ok = keys[at] == key[more]
            rank[more[ok]], merged[more[ok]] = ranks[at[ok]], pieces[at[ok]]
        return rank, merged

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(43)).astype(np.int64)

    def count(self, words: list[str], at_once: int = 16_384) -> np.ndarray:
        """As `count_some`, for so many words at a time that the arrays stay in the cache."""
        return np.concatenate([self.count_some(words[i : i + at_once]) for i in range(0, len(words), at_once)] or [np.zeros(0, np.int64)])

    def count_some(self, words: list[str]) -> np.ndarray:
        """Symbols of each word that survive all merges; a character that is no piece counts its UTF-8 bytes."""
        n = len(words)
        total = np.zeros(n, np.int64)
        if not n:
            return total
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        seq = np.repeat(np.arange(n), np.fromiter(map(len, words), np.int64, n))
        sym = self.char[code]
        # what each symbol counts in the end: one, or the bytes of an unknown character
        weight = np.where(sym >= 0, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        rank = np.full(len(sym), _NONE)
        new = np.full(len(sym), -1, np.int64)
        if len(sym) > 1:
            rank[:-1], new[:-1] = self.look_up(sym[:-1], sym[1:])
            rank[:-1][seq[:-1] != seq[1:]] = _NONE
        while len(sym):
            start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            low = np.minimum.reduceat(rank, start)
            size = np.diff(np.r_[start, len(seq)])
            over = low == _NONE
            if over.any():
                gone = np.repeat(over, size)
                total += np.bincount(seq[gone], weight[gone], n).astype(np.int64)
                stay = ~gone
                seq, sym, weight, rank, new = seq[stay], sym[stay], weight[stay], rank[stay], new[stay]
                if not len(sym):
                    break
                start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
                low, size = low[~over], size[~over]
            hit = np.flatnonzero(rank == np.repeat(low, size))
            # of pairs that overlap (the same piece repeated) every second one merges; of tied ranks the leftmost only
            run = np.cumsum(np.r_[True, np.diff(hit) != 1])
            first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            hit = hit[((np.arange(len(hit)) - np.repeat(first, np.diff(np.r_[first, len(hit)]))) % 2) == 0]
            if (tie := self.tied[rank[hit]]).any():
                lead = np.r_[True, seq[hit[1:]] != seq[hit[:-1]]]
                hit = hit[lead | ~tie]
            sym[hit] = new[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            at = place[hit]
            seq, sym, weight, rank, new = seq[keep], sym[keep], weight[keep], rank[keep], new[keep]
            again = np.unique(np.r_[at, at - 1])
            again = again[again >= 0]
            last = again == len(sym) - 1
            follow = np.where(last, again, again + 1)
            r, m = self.look_up(sym[again], sym[follow])
            rank[again] = np.where(last | (seq[again] != seq[follow]), _NONE, r)
            new[again] = m
        return total


def load_pieces(model_file: str) -> PairTable:
    """The normal pieces of a sentencepiece BPE model that neither rewrites characters nor joins spaces."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(model_file, "rb") as f:
        m.ParseFromString(f.read())
    norm = m.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only identity normalisation with a leading space is supported")
    normal = [p for p in m.pieces if p.type == 1]
    return PairTable([p.piece for p in normal], [p.score for p in normal])


_TABLES: dict[str, tuple[PairTable, dict[str, int]]] = {}


def count_tokens(texts: list[str | None], model_file: str) -> list[int]:
    """Tokens of each text."""
    if model_file not in _TABLES:
        _TABLES[model_file] = (load_pieces(model_file), {})
    table, seen = _TABLES[model_file]
    lists = [PRETOKEN.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    fresh = list(set().union(*lists).difference(seen))
    if len(seen) + len(fresh) > MEMORY:
        seen.clear()
        fresh = list(set().union(*lists))
    seen.update(zip(fresh, table.count(fresh).tolist(), strict=True))
    return [sum(map(seen.__getitem__, x)) for x in lists]


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row; one narrow pass without a shuffle.

    A null or empty text has no bytes and no tokens. Repeated rows are counted each; other columns are not read.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            n = pa.array(count_tokens(b.column("text").to_pylist(), model_file), pa.int64())
            size = pc.cast(pc.fill_null(pc.binary_length(b.column("text")), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
