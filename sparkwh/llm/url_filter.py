"""URL rules as one bit-parallel wildcard automaton.

Every glob becomes a chain of states, one bit each, and all chains lie side by side in a row of 64-bit words. Reading a
byte moves all of them at once: ``D = ((D << 1) & B[byte]) | (D & S[byte])``, the bit carried from word to word; ``B`` has
the states that the byte leads into, ``S`` those that a wildcard lets it stay in. A batch of URLs is read side by side, one
place after another; a URL is done when only states that nothing can leave are left.

Globs are matched against the canonical URL: a dot, the host (what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased) and the path (up to ``?``, ``#`` or the end, as it is). In a glob ``*`` is any run without a slash,
``**`` any run, ``?`` one character other than a slash; everything else stands for itself.

Defined results: a NULL url, or one without ``://``, has an empty host and path, which no rule fits. Very long URLs are read
whole. Of rules that fit, the longest (host and path together) decides, of equally long ones the first given. Repeated rows
are judged alike, other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import text_bytes, tidy

#: The tables take 4 kB per 64 states; so many states are the most one automaton may have.
MAX_STATES = 1 << 18
#: So few URLs are read one by one, with all words as one whole number.
FEW = 8
_CONTINUATION = range(0x80, 0xC0)
_SLASH = ord("/")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        """As a glob over canonical URLs: ``*.host/path**``. Wildcards in the rule keep their meaning."""
        return f"*.{self.host}{self.path}**"


class WildcardAutomaton:
    """All ``globs`` as one row of states. State 0 of a chain is its start; the last one accepts."""

    def __init__(self, globs: Iterable[str]):
        chains = [self._chain(g) for g in globs]
        states = sum(len(steps) + 1 for steps, _ in chains)
        if states > MAX_STATES:
            raise ValueError(f"{states} states, at most {MAX_STATES}")
        self.words = max(1, -(-states // 64))
        into, stay = np.zeros((256, self.words * 64), bool), np.zeros((256, self.words * 64), bool)
        self.starts, self.ends, at = [], [], 0
        for steps, loops in chains:
            self.starts.append(at)
            for k, accepted in enumerate(steps):
                into[list(accepted), at + k + 1] = True
            for k, accepted in enumerate(loops):
                stay[list(accepted), at + k] = True
            at += len(steps) + 1
            self.ends.append(at - 1)
        frozen = np.zeros(self.words * 64, bool)  # accepting states that every byte stays in
        frozen[self.ends] = stay[:, self.ends].all(axis=0)
        first = np.zeros(self.words * 64, bool)
        first[self.starts] = True
        self.into, self.stay = self._packed(into), self._packed(stay)
        self.alive, self.first = ~self._packed(frozen[None])[0], self._packed(first[None])[0]

    @staticmethod
    def _packed(flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags, axis=1, bitorder="little").view("<u8")

    @staticmethod
    def _chain(glob: str) -> tuple[list[frozenset[int]], list[set[int]]]:
        """The bytes each step accepts, and the bytes each state stays in on."""
        steps: list[frozenset[int]] = []
        loops: list[set[int]] = [set()]
        text, k = glob, 0
        while k < len(text):
            if text.startswith("**", k):
                loops[-1].update(range(256))
                k += 2
                continue
            if text[k] == "*":
                loops[-1].update(set(range(256)) - {_SLASH})
            elif text[k] == "?":  # a character: its first byte, then its continuation bytes
                steps.append(frozenset(set(range(256)) - {_SLASH} - set(_CONTINUATION)))
                loops.append(set(_CONTINUATION))
            else:
                for byte in text[k].encode():
                    steps.append(frozenset([byte]))
                    loops.append(set())
            k += 1
        return steps, loops

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(rows, globs): which globs fit which rows of UTF-8 bytes."""
        sizes = np.diff(offsets)
        state = np.repeat(self.first[None], len(sizes), axis=0)
        todo, place = np.flatnonzero(sizes > 0), 0
        while len(todo) > FEW:
            byte, held = data[offsets[todo] + place], state[todo]
            moved = held << np.uint64(1)
            moved[:, 1:] |= held[:, :-1] >> np.uint64(63)
            held = (moved & self.into[byte]) | (held & self.stay[byte])
            state[todo] = held
            place += 1
            todo = todo[(sizes[todo] > place) & (held & self.alive).any(axis=1)]
        if len(todo):
            self._one_by_one(data, offsets, todo, place, state)
        ends = np.array(self.ends, np.int64)
        return (state[:, ends >> 6] >> (ends & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def _one_by_one(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, place: int, state: np.ndarray) -> None:
        into, stay = ([int.from_bytes(w.tobytes(), "little") for w in table] for table in (self.into, self.stay))
        alive = int.from_bytes(self.alive.tobytes(), "little")
        for row in rows:
            held = int.from_bytes(state[row].tobytes(), "little")
            for byte in data[offsets[row] + place:offsets[row + 1]].tobytes():
                held = (held << 1) & into[byte] | held & stay[byte]
                if not held & alive:
                    break
            state[row] = np.frombuffer(held.to_bytes(8 * self.words, "little"), "<u8")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty for NULL and without ``://``."""
    mark = F.locate("://", url)
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    capital = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), capital, capital.lower()),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def judged(pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row: the longest rule that fits, else NULL and ``default``. A narrow pass over
    two columns; the automaton is built once per task."""
    order = sorted(range(len(rules)), key=lambda k: -len(rules[k].name))  # stable: of equal lengths the first given
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    canonical = parts.withColumn("canonical", F.concat(F.lit("."), "host", "path"))

    def run(batches):
        automaton = WildcardAutomaton(rules[k].glob for k in order)
        names = np.array([*(rules[k].name for k in order), None], object)
        verdicts = np.array([*(rules[k].verdict for k in order), default], object)
        for batch in batches:
            found = automaton.matches(*text_bytes(batch.column("canonical")))
            best = np.where(found.any(axis=1), found.argmax(axis=1), len(order)) if order else np.zeros(batch.num_rows, int)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(names[best], pa.string()),
                 pa.array(verdicts[best], pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    kind = parts.schema["page_id"].dataType.simpleString()
    return canonical.mapInArrow(tidy(run), f"page_id {kind}, host STRING, path STRING, rule STRING, verdict STRING")
