"""Token counts by a finite-state transducer that is compiled from the tokenizer's pieces.

The transducer reads one character per step; each transition carries the change of the token count. A state is what
the future of byte-pair merging can depend on: the longest suffix read that starts some piece and, for each of its own
suffixes that starts a piece, which token ended just before it and how many tokens ago. (A token sequence is the
merge result exactly if each adjacent pair is the merge result of its own text, so the last token before a position
settles which tokens may follow.) States are built when first met and kept in a hash table that whole arrays of texts
step through at once.

No piece has the space mark behind another character, so a space mark that follows another character leads from every
state to the same one: the maps of the chunks between such marks are constant, and composing the chunks of a text is
a prefix sum of their counts. All chunks of a slice of texts run side by side.

Cases: null and empty texts have no tokens; characters without a piece count their UTF-8 bytes; strings that look like
control tokens are ordinary text; texts are read whole, a chunk of any length is stepped through to its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk

#: The space mark of the pieces, and its code point.
MARK, MARK_POINT = "▁", 0x2581
#: States that are kept; beyond it the transducer is built anew.
MOST_STATES = 400_000
#: Below so many chunks side by side, a step at a time in Python is faster.
FEW = 24


class Transducer:
    """Counts of the pieces of a sentencepiece BPE model with byte fallback, no normalisation and a leading space mark."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = (m.is_control, m.is_unknown, m.is_byte, m.is_unused)
        self.score = {m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size()) if not any(is_(i) for is_ in kinds)}
        self.runs = {p for p in self.score if len(p) > 1 and set(p) == {MARK}}
        words = [p for p in self.score if p not in self.runs]
        if any(MARK in p[1:] for p in words) or self.runs and max(self.score[p] for p in self.runs) > min(self.score[p] for p in words if len(p) > 1):
            raise ValueError("pieces reach across space marks")
        self.starts = {p[:n] for p in words for n in range(len(p) + 1)}
        self.own: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.spaced: dict[tuple[int, str], int] = {}
        self.forget()

    def forget(self) -> None:
        start = ("", ((0, None, 0),))
        self.number, self.states = {start: 0}, [start]
        self.table_bits, self.filled = 16, 0
        self.keys, self.values = np.full(1 << 16, -1, np.int64), np.zeros(1 << 16, np.int64)

    # -- compiling

    def merged(self, text: str) -> list[str]:
        """Merge by score, leftmost first, as the definition says. For short texts."""
        s = list(text)
        while True:
            best = max(((self.score[s[i] + s[i + 1]], -i) for i in range(len(s) - 1) if s[i] + s[i + 1] in self.score), default=None)
            if best is None:
                return s
            s[-best[1] : 2 - best[1]] = [s[-best[1]] + s[1 - best[1]]]

    def is_token(self, t: str) -> bool:
        if len(t) == 1:
            return True
        if t not in self.score:
            return False
        if t not in self.own:
            self.own[t] = self.merged(t) == [t]
        return self.own[t]

    def may_follow(self, a: str, b: str) -> bool:
        if (a, b) not in self.pairs:
            if len(self.pairs) > MOST_STATES:
                self.pairs.clear()
            self.pairs[a, b] = self.merged(a + b) == [a, b]
        return self.pairs[a, b]

    def compile(self, state: int, c: str) -> tuple[int, int]:
        """The transition for one character: the next state and the change of the count."""
        suffix, before = self.states[state]
        known = {n: (token, ago) for n, token, ago in before}
        text = suffix + c
        n = next(n for n in range(len(text), -1, -1) if text[len(text) - n :] in self.starts)
        for size in range(max(n, 1), 0, -1):
            token = text[len(text) - size :]
            if size - 1 in known and self.is_token(token):
                last, ago = known[size - 1]
                if last is None or self.may_follow(last, token):
                    break
        else:
            raise AssertionError("no token ends here")
        change = ago + (1 if token in self.score else len(token.encode()))
        ends = [(0, token if token in self.score else None, 0)]
        ends += [(k, known[k - 1][0], known[k - 1][1] - change) for k in range(1, n + 1) if text[len(text) - k :] in self.starts]
        to = (text[len(text) - n :], tuple(ends))
        if to not in self.number:
            self.number[to] = len(self.states)
            self.states.append(to)
        return self.number[to], change

    # -- the table of transitions: key state * 2**21 + code point, value next state * 2**10 + change + 512

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (tk.mix(keys.astype(np.uint64)) >> np.uint64(64 - self.table_bits)).astype(np.int64)

    def look(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where there is none."""
        slot, out = self._slot(keys), np.full(len(keys), -1, np.int64)
        found = self.keys[slot]
        hit = found == keys
        out[hit] = self.values[slot[hit]]
        left = np.flatnonzero(~hit & (found >= 0))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.keys) - 1)
            found = self.keys[slot]
            hit = found == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            more = ~hit & (found >= 0)
            left, slot = left[more], slot[more]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add different keys that aren't there yet."""
        if 2 * (self.filled + len(keys)) > len(self.keys):
            old = self.keys >= 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            while 3 * len(keys) > 1 << self.table_bits:
                self.table_bits += 1
            self.keys, self.values, self.filled = np.full(1 << self.table_bits, -1, np.int64), np.zeros(1 << self.table_bits, np.int64), 0
        self.filled += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            taken, at = np.unique(slot[free], return_index=True)
            own = free[at]
            self.keys[taken], self.values[taken] = keys[own], values[own]
            left = np.ones(len(keys), bool)
            left[own] = False
            keys, values = keys[left], values[left]
            slot = (slot[left] + 1) & (len(self.keys) - 1)

    def step(self, states: np.ndarray, points: np.ndarray) -> np.ndarray:
        keys = (states << 21) | points
        values = self.look(keys)
        new = np.unique(keys[values < 0])
        if len(new):
            made = [self.compile(k >> 21, chr(k & 0x1FFFFF)) for k in new.tolist()]
            self.put(new, np.array([(s << 10) | (d + 512) for s, d in made], np.int64))
            values = self.look(keys)
        return values

    # -- counting

    def chunks(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each span of ``points``; a span begins in the first state."""
        order = np.argsort(start - end, kind="stable")  # longest first
        start, size = start[order], (end - start)[order]
        state, count, live = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), len(start)
        at = 0
        while live and (live > FEW or at < 64):
            values = self.step(state[:live], points[start[:live] + at])
            state[:live] = values >> 10
            count[:live] += (values & 1023) - 512
            at += 1
            live = int(np.searchsorted(-size, -at, "left"))
        for i in range(live):
            s, n, memo = int(state[i]), 0, {}
            for p in points[start[i] + at : start[i] + size[i]].tolist():
                if (k := (s << 21) | p) not in memo:
                    memo[k] = int(self.step(np.array([s], np.int64), np.array([p], np.int64))[0])
                s, n = memo[k] >> 10, n + (memo[k] & 1023) - 512
            count[i] += n
        out = np.empty(len(start), np.int64)
        out[order] = count
        return out

    def tokens(self, text: str) -> list[str]:
        """The tokens themselves, by the same states."""
        s, ends = 0, []
        for i, c in enumerate(text):
            k = np.array([(s << 21) | ord(c)], np.int64)
            if (v := int(self.look(k)[0])) < 0:
                v = (lambda x: (x[0] << 10) | (x[1] + 512))(self.compile(s, c))
                self.put(k, np.array([v], np.int64))
            s = v >> 10
            last = self.states[s][1][0][1] or c
            ends.append((i + 1 - len(last), last))
        out, at = [], len(text)
        while at:
            at, token = ends[at - 1]
            out.append(token)
        return out[::-1]

    @lru_cache(4096)
    def run(self, n: int) -> int:
        """Tokens of ``n`` space marks. Long runs repeat the longest piece where the short ones do."""
        longest = max(map(len, self.runs), default=1)
        if n > 6 * longest and all(len(self.merged(MARK * k)) == len(self.merged(MARK * (k - longest))) + 1 for k in range(3 * longest, 5 * longest)):
            laps = (n - 4 * longest) // longest
            return laps + self.run(n - laps * longest)
        return len(self.merged(MARK * n))

    def after_run(self, n: int, word: str) -> int:
        """Tokens of ``n`` > 1 space marks and what follows; marks join each other after all else."""
        if not word:
            return self.run(n)
        if (n, word) not in self.spaced:
            if len(self.spaced) > 50_000:
                self.spaced.clear()
            tokens = self.tokens(MARK + word)
            self.spaced[n, word] = len(tokens) - 1 + self.run(n) if tokens[0] == MARK else len(tokens) + self.run(n - 1)
        return self.spaced[n, word]

    def count(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        if len(self.states) > MOST_STATES:
            self.forget()
        data, offs = tk.flat(column)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        offs = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offs)
        points[points == 0x20] = MARK_POINT
        full = np.diff(offs) > 0
        points = np.insert(points, offs[:-1][full], MARK_POINT)
        offs = offs + np.r_[0, np.cumsum(full)]
        if not len(points):
            return np.zeros(len(full), np.int64)
        mark = points == MARK_POINT
        begin = mark & ~np.r_[False, mark[:-1]]
        begin[offs[:-1][full]] = True
        start = np.flatnonzero(begin)
        end = np.r_[start[1:], len(points)]
        # equal chunks are counted once
        up, down = tk.powers(len(points) + 1)
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(tk.mix(points.astype(np.uint64)) * up[: len(points)])]
        h = tk.mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        _, once, back = np.unique(h, return_index=True, return_inverse=True)
        start_, end_ = start[once], end[once]
        run = np.flatnonzero(np.minimum(start_ + 1, len(points) - 1) < end_)
        run = run[mark[np.minimum(start_[run] + 1, len(points) - 1)]]
        plain = np.ones(len(once), bool)
        plain[run] = False
        counts = np.zeros(len(once), np.int64)
        counts[plain] = self.chunks(points, start_[plain], end_[plain])
        for i in run.tolist():
            chars = points[start_[i] : end_[i]]
            n = int(np.argmin(chars == MARK_POINT)) if not mark[start_[i] : end_[i]].all() else len(chars)
            counts[i] = self.after_run(n, chars[n:].astype("<u4").tobytes().decode("utf-32-le"))
        sums = np.r_[0, np.cumsum(counts[back])]  # the scan over chunks
        return np.diff(sums[np.searchsorted(start, offs)])


@lru_cache(2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than ``limit``).

    Columns of these names are replaced. A narrow pass; nothing is shuffled.
    """
    rest = [c for c in docs.columns if c not in ("text", "n_bytes", "n_tokens", "over_limit")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for b in tk.slices(batches):
            column = b.column(b.schema.get_field_index("text"))
            n = t.count(column)
            size = np.diff(tk.flat(column)[1])
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in rest), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)], [*rest, "n_bytes", "n_tokens", "over_limit"])

    schema = docs.select(rest).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    return docs.select(*rest, F.col("text").cast("string").alias("text")).mapInArrow(work, schema)
