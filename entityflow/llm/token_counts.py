"""Token counts by rank-synchronous merging of ragged numpy arrays.

Texts are cut into pre-tokens that no vocabulary piece spans (a run of word
separators with the word behind it). The distinct pre-tokens of a batch that
are not in the memo lie in one flat array of symbol ids with row offsets; each
step finds every sequence's lowest-rank pair at once and merges it, until no
sequence has a pair left. A sequence merges all its places of that pair in one
step unless a merge would create a pair of lower rank, in which case only the
leftmost place is merged, as the sequential rule does.

Edge cases: null and empty texts have 0 tokens; characters outside the
vocabulary count as their UTF-8 bytes (byte fallback). Repeated rows are
counted each; every input row gives one output row.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ._common import CACHES, col, map_rows, read

SEP = "▁"
#: Memo entries a worker keeps; the memo starts anew beyond it.
MEMO = 500_000
_UNIT = re.compile(f"{SEP}+[^{SEP}]*|[^{SEP}]+")
_NO_RANK = np.int64(1) << 40


class Merger:
    """Pair table of a SentencePiece BPE vocabulary: (left symbol, right symbol) -> (rank, merged symbol)."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        pieces = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(SEP in p.lstrip(SEP) for p in pieces):
            raise ValueError("a piece spans a word separator")
        by_score = sorted((-sp.get_score(i), i, p) for p, i in pieces.items() if len(p) > 1)
        self.chars = {p: i for p, i in pieces.items() if len(p) == 1}
        self.known = set(self.chars.values())
        symbols = dict(pieces)
        for p in pieces:  # characters that occur only inside pieces are symbols too
            for c in p:
                symbols.setdefault(c, len(symbols) + n)
        self.chars = {p: i for p, i in symbols.items() if len(p) == 1}
        self.single = np.array(sorted(i for c, i in self.chars.items() if c not in pieces), np.int64)
        self.bytes_of = {i: len(c.encode()) for c, i in self.chars.items() if c not in pieces}
        self.next_id = max(symbols.values()) + 1
        rows = []
        for rank, (_, i, p) in enumerate(by_score):
            rows += [(symbols[p[:k]] << 32 | symbols[p[k:]], rank, i) for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.made = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()
        bits = 1 << 20
        self.bits, self.filter = np.uint64(64 - 20), np.zeros(bits, bool)
        self.filter[self._slot(self.keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.bits

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; _NO_RANK where there is none."""
        keys = (left << 32) | right
        rank, made = np.full(len(keys), _NO_RANK), np.zeros(len(keys), np.int64)
        maybe = np.flatnonzero(self.filter[self._slot(keys)])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == keys[maybe]
        rank[maybe[hit]], made[maybe[hit]] = self.ranks[at[hit]], self.made[at[hit]]
        return rank, made

    def counts(self, units: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        total, widths = np.zeros(len(units), np.int64), {}
        flat: list[int] = []
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        get = self.chars.get
        for u in units:
            for c in u:
                i = get(c)
                if i is None:  # outside the vocabulary: never merges
                    i = self.next_id + len(c.encode())
                flat.append(i)
        ids = np.array(flat, np.int64)
        for i, b in self.bytes_of.items():
            widths[i] = b
        seq = np.repeat(np.arange(len(units)), sizes)
        while len(ids):
            same = seq[1:] == seq[:-1]
            rank, made = self.pairs(ids[:-1], ids[1:])
            rank[~same] = _NO_RANK
            rank = np.append(rank, _NO_RANK)
            starts = np.flatnonzero(np.r_[True, ~same])
            low = np.minimum.reduceat(rank, starts)
            live = low < _NO_RANK
            run = np.diff(np.r_[starts, len(ids)])
            if not live.all():  # finished sequences leave the arrays
                gone = np.repeat(~live, run)
                total += self._surviving(ids[gone], seq[gone], len(units), widths)
                keep = ~gone
                ids, seq, rank, made = ids[keep], seq[keep], rank[keep], np.append(made, 0)[keep]
                run, low = run[live], low[live]
                if not len(ids):
                    break
            else:
                made = np.append(made, 0)
            low_each = np.repeat(low, run)
            place = np.flatnonzero(rank == low_each)
            # Leftmost first, without overlaps: within a chain of adjacent places every second one.
            head = np.r_[True, (np.diff(place) != 1) | (seq[place[1:]] != seq[place[:-1]])]
            order = np.arange(len(place))
            place = place[(order - np.maximum.accumulate(np.where(head, order, 0))) % 2 == 0]
            new, new_seq, at = self._merge(ids, seq, made, place)
            many = np.bincount(seq[place], minlength=len(units)) > 1
            if many.any():
                around = np.concatenate([np.stack([at - 1, at]), np.stack([at, at + 1])], axis=1)
                around = around[:, (around[0] >= 0) & (around[1] < len(new))]
                around = around[:, new_seq[around[0]] == new_seq[around[1]]]
                got, _ = self.pairs(new[around[0]], new[around[1]])
                limit = np.full(len(units), -1, np.int64)
                limit[seq[np.cumsum(run) - 1]] = low
                early = np.unique(new_seq[around[0]][got < limit[new_seq[around[0]]]])
                early = early[many[early]]
                if len(early):
                    first = np.r_[True, seq[place[1:]] != seq[place[:-1]]]
                    place = place[first | ~np.isin(seq[place], early)]
                    new, new_seq, at = self._merge(ids, seq, made, place)
            ids, seq = new, new_seq
        return total

    @staticmethod
    def _merge(ids: np.ndarray, seq: np.ndarray, made: np.ndarray, place: np.ndarray):
        new = ids.copy()
        new[place] = made[place]
        keep = np.ones(len(ids), bool)
        keep[place + 1] = False
        return new[keep], seq[keep], np.cumsum(keep)[place] - 1

    def _surviving(self, ids: np.ndarray, seq: np.ndarray, n: int, widths: dict) -> np.ndarray:
        weight = np.where(ids > self.next_id, ids - self.next_id, 1)
        if len(self.single):
            odd = np.isin(ids, self.single)
            weight[odd] = [widths[i] for i in ids[odd].tolist()]
        return np.bincount(seq, weights=weight, minlength=n).astype(np.int64)


@lru_cache(4)
def merger(model_file: str) -> Merger:
    return Merger(model_file)


class Counter:
    """Counts whole texts, remembering pre-tokens up to a bound."""

    def __init__(self, model_file: str, memo: int = MEMO):
        self.merger, self.memo, self.most = merger(model_file), {}, memo

    def __call__(self, texts: list[str]) -> list[int]:
        # The model puts one separator before a text and turns spaces into separators; nothing else is normalised.
        units = [_UNIT.findall(SEP + t.replace(" ", SEP)) if t else [] for t in texts]
        memo = self.memo
        if len(memo) > self.most:
            memo.clear()
        new = list({u for us in units for u in us if u not in memo})
        for k in range(0, len(new), 20_000):
            part = new[k : k + 20_000]
            memo.update(zip(part, self.merger.counts(part).tolist()))
        return [sum(map(memo.__getitem__, us)) for us in units]


@lru_cache(4)
def counter(model_file: str) -> Counter:
    """One memo a worker process, kept from task to task."""
    return Counter(model_file)


def count_tokens(df: DataFrame, model_file: str, text: str = "text", id_col: str = "doc_id", limit: int = 4096) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit per row."""
    def make():
        count = counter(model_file)

        def f(ids, texts):
            texts = [t or "" for t in texts]
            n = count(texts)
            return [ids, [len(t.encode()) for t in texts], n, [x > limit for x in n]]

        return f

    return map_rows(df, [col(id_col).cast("long"), col(text)], make, "id long, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op8_token_counts": op8_token_counts}
ORACLES: dict[str, str] = {}
CACHES[__name__] = [counter.cache_clear, merger.cache_clear]
