"""SentencePiece encoding and decoding with a table of last tokens per prefix.

In merge-type (BPE) encoding every prefix of a text has one encoding, so it has one last token. Token t is the last one
of prefix i if it ends there and it can follow the last token of the prefix that it leaves over, that is, if the two
side by side are encoded as these two. An automaton over all pieces gives the candidates of each position; the ids are
then read backwards from the last prefix.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The mark that stands for a space, and what undecodable bytes become.
MARK = "▁"
REPLACEMENT = "�"
#: Bytes of segments' encodings and number of tests of pairs that are remembered, until a task ends at the latest; only
#: speed depends on it. An entry takes about ``ENTRY`` bytes besides its own.
CACHE_BYTES, CACHE_PAIRS, ENTRY = 64 << 20, 200_000, 200
#: Characters of texts whose segments are looked at together, longest segment and number of them in one table.
CHARS, WIDE, GROUP, FEW = 1_000_000, 40, 16384, 200
#: Texts encoded and decoded before they are handed on.
ROWS = 512
BPE = 2
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message: (number, integer or bytes)."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or _varint(data, at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def portions(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Texts in lists of about CHARS characters; a longer text is a list of its own."""
    part: list[str | None] = []
    chars = 0
    for text in texts:
        if part and chars + len(text or "") > CHARS:
            yield part
            part, chars = [], 0
        part.append(text)
        chars += len(text or "")
    if part:
        yield part


class Table:
    """A hash table of non-negative integers, looked up and filled by arrays."""

    def __init__(self, bits: int = 12):
        self.bits, self.count = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for those that are not there."""
        at = self.slots(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.values[at], -1)
        rest = np.flatnonzero((held != keys) & (held >= 0))
        at = at[rest]
        while len(rest):
            at = (at + 1) & (len(self.keys) - 1)
            held, wanted = self.keys[at], keys[rest]
            hit = held == wanted
            found[rest[hit]] = self.values[at[hit]]
            go = ~hit & (held >= 0)
            rest, at = rest[go], at[go]
        return found

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not there."""
        self.count += len(keys)
        if 2 * self.count > len(self.keys):
            had = self.keys >= 0
            keys, values = np.concatenate([self.keys[had], keys]), np.concatenate([self.values[had], values])
            self.bits = int(np.ceil(np.log2(4 * len(keys))))
            self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        at, rest = self.slots(keys), np.arange(len(keys))
        while len(rest):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[rest[free]]  # of several the last one gets the place
            done = self.keys[at] == keys[rest]
            self.values[at[done]] = values[rest[done]]
            rest, at = rest[~done], (at[~done] + 1) & (len(self.keys) - 1)


class Machine:
    """The automaton of all pieces as arrays, which many words walk through at once."""

    def __init__(self, pieces: dict[str, int]):
        self.letters = np.zeros(0x110000, np.int64)  # 0: in no piece
        known = sorted({c for name in pieces for c in name})
        self.letters[[ord(c) for c in known]] = np.arange(1, len(known) + 1)
        self.size = len(known) + 1
        children: list[dict[int, int]] = [{}]
        token = [-1]
        for name, i in pieces.items():
            node = 0
            for c in self.letters[[ord(c) for c in name]].tolist():
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    token.append(-1)
                node = children[node][c]
            token[node] = i
        back, shorter = [0] * len(children), [0] * len(children)  # longest suffix, and the longest that is a piece
        order = [0]
        for node in order:
            for c, child in children[node].items():
                order.append(child)
                if node:
                    k = back[node]
                    while k and c not in children[k]:
                        k = back[k]
                    back[child] = children[k].get(c, 0)
                k = back[child]
                shorter[child] = k if token[k] >= 0 else shorter[k]
        self.token, self.back, self.shorter = (np.array(x, np.int64) for x in (token, back, shorter))
        self.first = np.where(self.token >= 0, np.arange(len(token)), self.shorter)
        self.moves = Table()
        edges = [(node * self.size + c, child) for node, row in enumerate(children) for c, child in row.items()]
        self.moves.add(np.array([x for x, _ in edges], np.int64), np.array([x for _, x in edges], np.int32))

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The longest suffix of what has been read that begins some piece."""
        out = self.moves.find(nodes * self.size + letters).astype(np.int64)
        lost = np.flatnonzero((out < 0) & (nodes > 0) & (letters > 0))
        nodes = nodes[lost]
        while len(lost):
            nodes = self.back[nodes]
            met = self.moves.find(nodes * self.size + letters[lost])
            out[lost] = met
            go = (met < 0) & (nodes > 0)
            lost, nodes = lost[go], nodes[go]
        return np.maximum(out, 0)


class Pieces:
    """A merge-type SentencePiece model: ``encode`` and ``decode`` agree with the library's."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            spec = dict(x for x in _fields(file.read()) if x[0] in (2, 3))
        trainer, normalizer = dict(_fields(spec[2])), dict(_fields(spec[3]))
        if trainer.get(3, 1) != BPE or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only merge-type models without text normalisation are supported")
        self.prefix = MARK if normalizer.get(3, 1) else ""
        size = model.vocab_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.bos, self.eos, self.unk = model.bos_id(), model.eos_id(), model.unk_id()
        special = [model.is_control(i) or model.is_unused(i) or model.is_unknown(i) for i in range(size)]
        self.bytes = {i: int(self.names[i][1:-1], 16) for i in range(size) if model.is_byte(i)}
        self.of_byte = {b: i for i, b in self.bytes.items()}
        self.high = {i for i, b in self.bytes.items() if b >= 128}  # those that are no character alone
        self.shown = [self.names[i].replace(MARK, " ") for i in range(size)]
        for i in range(size):
            if special[i]:
                self.shown[i] = "" if model.is_control(i) else model.decode([i])
            elif i in self.bytes:
                self.shown[i] = chr(self.bytes[i])
        self.ids = {self.names[i]: i for i in range(size) if not special[i] and i not in self.bytes}
        self.scores = {name: model.get_score(i) for name, i in self.ids.items()}
        marks = {name for name in self.ids if len(name) > 1 and not name.strip(MARK)}
        others = [name for name in self.ids if len(name) > 1 and name not in marks]
        # What lets a text be cut before each run of marks, and a run be merged by itself.
        self.by_runs = (
            all(MARK not in name[1:] for name in others)
            and len({self.scores[name] for name in others}) == len(others)
            and max((self.scores[x] for x in marks), default=-np.inf) < min((self.scores[x] for x in others), default=0)
        )
        self.automaton = ahocorasick.Automaton()
        for name, i in self.ids.items():
            if name not in marks:
                self.automaton.add_word(name, (i, len(name)))
        if len(self.automaton):
            self.automaton.make_automaton()
        # Characters that stand side by side in some piece; any other two are always cut apart.
        self.touching = {pair for name in self.ids for pair in zip(name, name[1:])}
        self.lines = not any("\n" in pair for pair in self.touching)
        self.sizes = [len(name) for name in self.names]
        self.machine = Machine({name: i for name, i in self.ids.items() if name not in marks})
        self.lengths = np.array(self.sizes)
        self.segment = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.forget()

    def forget(self) -> None:
        """Drop what texts have left behind; the model stays."""
        self.pairs, self.tested = Table(), {}
        self.cache: dict[str, bytes] = {"": b""}
        self.held = 0

    def merge(self, text: str) -> list[int]:
        """The encoding by merging itself: the best scored adjacent pair first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts) and (score := self.scores.get(both := parts[left] + parts[right])) is not None:
                heapq.heappush(queue, (-score, left, both))

        for k in range(len(parts) - 1):
            offer(k)
        while queue:
            _, left, both = heapq.heappop(queue)
            right = after[left] if parts[left] is not None else len(parts)
            if right >= len(parts) or parts[left] + parts[right] != both:
                continue  # one of the two is gone or has grown
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [i for part in parts if part is not None for i in self.single(part)]

    def single(self, part: str) -> list[int]:
        """The id of a piece, or those of the bytes of a character that is none."""
        if part in self.ids:
            return [self.ids[part]]
        if len(self.of_byte) == 256:
            return [self.of_byte[b] for b in part.encode()]
        return [self.unk]

    def merge_short(self, text: str) -> list[int]:
        """``merge`` for a text of known characters and the length of a few pieces."""
        parts = list(text)
        gain = [self.scores.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
        while gain and (best := max(gain)) > -np.inf:
            k = gain.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del gain[k]
            if k < len(gain):
                gain[k] = self.scores.get(parts[k] + parts[k + 1], -np.inf)
            if k:
                gain[k - 1] = self.scores.get(parts[k - 1] + parts[k], -np.inf)
        return [self.ids[x] for x in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and then ``right`` is how their joint text is encoded; after -1, how its own text is."""
        if left < 0 or (self.names[left][-1], self.names[right][0]) not in self.touching:
            return self.merge_short(self.names[right]) == [right]
        return self.merge_short(self.names[left] + self.names[right]) == [left, right]

    def all_fit(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """``fits`` for arrays, each pair tested once."""
        keys = (lefts + 1) * len(self.names) + rights
        found = self.pairs.find(keys)
        if (new := np.unique(keys[found < 0])).size:
            if self.pairs.count > CACHE_PAIRS:
                self.pairs = Table()
                new = np.unique(keys)
            tests = [self.fits(k // len(self.names) - 1, k % len(self.names)) for k in new.tolist()]
            self.pairs.add(new, np.array(tests, np.int32))
            found = self.pairs.find(keys)
        return found > 0

    def table(self, text: str) -> list[int]:
        """The encoding of one long text by the table of each prefix's last token."""
        last = [-1] * len(text)  # -1: the character is no piece and stands alone
        tested, done = self.tested, -1
        if len(tested) > CACHE_PAIRS:
            tested.clear()
        for end, (token, size) in self.automaton.iter(text) if len(self.automaton) else ():
            if end == done:
                continue  # the last token is unique
            pair = (last[end - size] if size <= end else -1, token)
            fits = tested.get(pair)
            if fits is None:
                fits = tested[pair] = self.fits(*pair)
            if fits:
                last[end], done = token, end
        ids: list[int] = []
        end = len(text) - 1
        while end >= 0:
            token = last[end]
            if token < 0:
                ids.extend(reversed(self.single(text[end])))
                end -= 1
            else:
                ids.append(token)
                end -= self.sizes[token]
        ids.reverse()
        return ids

    def tables(self, words: list[str]) -> list[bytes | None]:
        """Packed encodings of many short words by the same table, a row per word; None where a character is no piece.

        ``words`` are sorted by length, so those that go on after a place are the last ones.
        """
        sizes = np.array([len(x) for x in words])
        width, n = int(sizes[-1]), len(words)
        codes = np.frombuffer("".join(x.ljust(width, "\0") for x in words).encode("utf-32-le", "surrogatepass"), "<u4")
        letters = self.machine.letters[codes.reshape(n, width)]
        last = np.full((n, width), -1, np.int64)
        nodes = np.zeros(n, np.int64)
        for end in range(width):
            open_from = int(np.searchsorted(sizes, end, "right"))
            nodes[open_from:] = self.machine.step(nodes[open_from:], letters[open_from:, end])
            rows = np.arange(open_from, n)
            at = self.machine.first[nodes[open_from:]]
            while (met := at > 0).any():
                rows, at = rows[met], at[met]
                tokens = self.machine.token[at]
                starts = end - self.lengths[tokens]
                before = np.where(starts < 0, -1, last[rows, starts])
                fits = self.all_fit(before, tokens)
                last[rows[fits], end] = tokens[fits]
                rows, at = rows[~fits], self.machine.shorter[at[~fits]]
        ends, steps, whole = sizes - 1, [], np.ones(n, bool)
        while (going := ends >= 0).any():
            tokens = np.where(going, last[np.arange(n), ends], -1)
            whole &= (tokens >= 0) | ~going
            steps.append(tokens)
            ends = np.where(tokens >= 0, ends - self.lengths[tokens], -1)
        forward = np.stack(steps[::-1], axis=1)
        kept = forward >= 0
        data = forward[kept].astype("<u4").tobytes()
        cuts = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]) * 4
        return [data[a:b] if ok else None for a, b, ok in zip(cuts[:-1].tolist(), cuts[1:].tolist(), whole.tolist())]

    def encode_segment(self, segment: str) -> list[int]:
        """A run of marks and what follows it up to the next mark."""
        run = len(segment) - len(segment.lstrip(MARK))
        if run == len(segment):
            return self.merge(segment)
        ids = self.table(segment[max(0, run - 1) :])
        if run < 2:
            return ids
        if ids[0] == self.ids.get(MARK):
            return self.merge(MARK * run) + ids[1:]  # the last mark didn't join the word
        return self.merge(MARK * (run - 1)) + ids

    def segments(self, text: str) -> list[str]:
        """Parts that are encoded by themselves: runs of marks with what follows, and line ends if no piece has any."""
        if not self.by_runs:
            return [self.prefix + text.replace(" ", MARK)] if text else []
        text = text.replace(MARK, " ")
        if not text:
            return []
        if "  " in text or (self.prefix and text[0] == " "):
            return self.segment.findall(self.prefix + text.replace(" ", MARK))
        cut = self.prefix + text.replace(" ", f" {MARK}")
        return (cut.replace("\n", " \n ") if self.lines else cut).split(" ")

    def learn(self, segments: set[str]) -> None:
        """Put the encodings of segments into the cache."""
        short = sorted((x for x in segments if len(x) <= WIDE and MARK not in x[1:]), key=len) if self.by_runs else []
        if len(short) < FEW:
            short = []
        for at in range(0, len(short), GROUP):
            words = short[at : at + GROUP]
            self.cache.update((x, ids) for x, ids in zip(words, self.tables(words)) if ids is not None)
        for segment in segments.difference(self.cache):
            self.cache[segment] = pack(self.encode_segment(segment) if self.by_runs else self.merge(segment))

    def encode_all(self, texts: Iterable[str | None], begin: bool = True, end: bool = True) -> list[bytes]:
        """Ids of each whole text (null: empty) as little-endian unsigned 32-bit integers."""
        head, tail = pack([self.bos] * begin), pack([self.eos] * end)
        out: list[bytes] = []
        for part in portions(texts):
            cut = [self.segments(x or "") for x in part]
            new = set(chain.from_iterable(cut)).difference(self.cache)
            self.learn(new)
            out += [b"".join((head, *map(self.cache.__getitem__, x), tail)) for x in cut]
            for segment in new:
                if len(segment) > WIDE:
                    del self.cache[segment]
                else:
                    self.held += ENTRY + len(segment) + len(self.cache[segment])
            if self.held > CACHE_BYTES:
                self.cache, self.held = {"": b""}, 0
        return out

    def encode(self, text: str | None, begin: bool = True, end: bool = True) -> bytes:
        return self.encode_all([text], begin, end)[0]

    def decode(self, data: bytes) -> str:
        """The text of ids: control tokens are dropped, runs of byte tokens are read as UTF-8."""
        ids = np.frombuffer(data, "<u4").tolist()
        shown = map(self.shown.__getitem__, ids) if self.high.isdisjoint(ids) else self._shown_with_bytes(ids)
        text = "".join(shown)
        first = next((i for i in ids if i not in (self.bos, self.eos)), None)
        opens = self.prefix and first is not None and self.names[first].startswith(MARK)
        return text[1:] if opens and text.startswith(" ") else text

    def _shown_with_bytes(self, ids: Iterable[int]) -> Iterator[str]:
        held = bytearray()
        for i in ids:
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            if held:
                yield from utf8(held)
                held = bytearray()
            yield self.shown[i]
        yield from utf8(held)


def utf8(data: bytes | bytearray) -> Iterator[str]:
    """Characters of UTF-8 bytes; each byte that belongs to none becomes a replacement character."""
    at = 0
    while at < len(data):
        lead = data[at]
        size = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4
        try:
            yield bytes(data[at : at + size]).decode()
            at += size
        except UnicodeDecodeError:
            yield REPLACEMENT
            at += 1


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The model of a file that every worker can read, built once per worker."""
    return Pieces(path)


def encode(text: Column, path: str, begin: bool = True, end: bool = True) -> Column:
    """Binary column of the ids of each whole text, little-endian unsigned 32-bit integers.

    A null or empty text gives the begin and end ids alone. ``path`` must be readable by every worker, as installed
    with the tokenizers.
    """

    @F.pandas_udf("binary")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pieces(path)
        try:
            for texts in parts:
                for at in range(0, len(texts), ROWS):
                    yield pd.Series(model.encode_all(texts.iloc[at : at + ROWS], begin, end), dtype=object)
        finally:
            model.forget()

    return encoded(text)


def decode(ids: Column, path: str) -> Column:
    """String column of the text of such ids; null ids give null."""

    @F.pandas_udf("string")
    def decoded(values: pd.Series) -> pd.Series:
        model = pieces(path)
        return pd.Series([None if x is None else model.decode(x) for x in values], dtype=object)

    return decoded(ids)


def with_pieces(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the ids of each whole text and the text they decode to; columns of these names are replaced.

    A null or empty text gives the begin and end ids alone, which decode to an empty text. Equal rows get equal results,
    an empty table an empty one, and other columns stay. Texts are taken whole, however long.
    """

    @F.pandas_udf("ids binary, decoded string")
    def both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = pieces(path)
        try:
            for texts in parts:
                for at in range(0, len(texts), ROWS):
                    found = model.encode_all(texts.iloc[at : at + ROWS])
                    yield pd.DataFrame({"ids": found, "decoded": list(map(model.decode, found))}, dtype=object)
        finally:
            model.forget()

    name = "_pieces"
    while name in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    found = docs.withColumn(name, both(F.col(text)))
    return found.withColumns({ids: F.col(name)["ids"], decoded: F.col(name)["decoded"]}).drop(name)
