"""Operator 10: language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built; a text is
parsed against it from left to right into longest phrases that occur in the
labelled text (a character that doesn't occur is a phrase of its own). The
language that needs the fewest phrases, normalised as phrases * log2(size of
its labelled text) / characters, wins. Texts are parsed in lower case, each run
of other than letters read as one space. All stretches of ``STRETCH`` characters
of a slice of texts advance through the automata together, one array step a
character; each begins as if a phrase did, and where its predecessor ends within
a phrase its first steps are done again from there until both parses agree (to
its end, and so on one by one, in even text where they never do), so the phrases
are those of the whole text and ``STRETCH`` changes no result.

The automata's moves are one hash table of (state, character), as large as the
labelled text and not as its alphabet.

The labelled text is a bounded sample: per language at most ``TRAIN_CHARS``
characters, ``TOTAL_CHARS`` / languages where that is less, of documents in the
order of a hash of their ids, ``PIECE`` characters of each from a place chosen
by that hash; of more than ``LANGS`` labels the most frequent are learned. All
texts are scored in full.

Defined results: ``und`` with score 0 for null texts, texts without a letter
and where nothing could be learned; ties go to the first language by name; the
score is 1 - best / second best (1 with a single language). Rows are scored one
by one, so repeated rows repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from bizlens.llm.common import crc_mod, documents, py_texts, slices, small_batches

TRAIN_CHARS, TOTAL_CHARS, PIECE, STRETCH, LANGS = 24_000, 400_000, 400, 2048, 2000
SPACE = 0
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every run of ``codes``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Moves:
    """(state, character class) -> next state, by open addressing; a quarter of the slots are taken at most."""

    def __init__(self, keys: np.ndarray, to: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        at = self._first(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            mine = self.keys[at] == keys
            self.to[at[mine]] = to[mine]
            keys, to, at = keys[~mine], to[~mine], (at[~mine] + 1) & self.mask
        self.slots, self.states = memoryview(self.keys), memoryview(self.to)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * SPREAD) >> self.shift).astype(np.int64)

    def one(self, key: int) -> int:
        at = (key * int(SPREAD) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while (there := self.slots[at]) != key:
            if there < 0:
                return -1
            at = (at + 1) & self.mask
        return self.states[at]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Next states; -1 where there is none."""
        at = self._first(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.to[at], -1)
        far = np.flatnonzero((there != keys) & (there >= 0))
        while len(far):
            at[far] = (at[far] + 1) & self.mask
            there = self.keys[at[far]]
            hit = there == keys[far]
            out[far[hit]] = self.to[at[far[hit]]]
            far = far[~hit & (there >= 0)]
        return out


class CrossParser:
    """Automata of all languages, their states numbered in a row."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        letters = sorted({c for t in samples.values() for c in t if c.isalpha()})
        own = {c: k + 1 for k, c in enumerate(letters)}
        other = len(letters) + 1  # letters that no sample has
        self.width = other + 1
        self.classes = np.zeros(0x110000, np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                self.classes[cp] = own.get(low, other) if len(low) == 1 else own.get(c, other)
        keys, to, base, self.roots, self.weight = [], [], 0, [], []
        for lang in self.langs:
            codes, _ = self.codes([samples[lang]])
            moves = suffix_automaton(codes.tolist())
            sizes = np.array([len(m) for m in moves], np.int64)
            state = np.repeat(np.arange(len(moves), dtype=np.int64) + base, sizes)
            keys.append(state * self.width + np.array([c for m in moves for c in m], np.int64))
            to.append(np.array([q for m in moves for q in m.values()], np.int32) + np.int32(base))
            self.roots.append(base)
            self.weight.append(np.log2(len(codes) + 1))
            base += len(moves)
        self.moves = Moves(np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int32), *to]))

    def step(self, state: np.ndarray, root: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next states, the places where a phrase ends, and how many end there (one or two)."""
        nxt = self.moves.find(state * self.width + codes).astype(np.int64)
        miss = np.flatnonzero(nxt < 0)
        again = self.moves.find(root[miss] * self.width + codes[miss])
        nxt[miss] = np.where(again < 0, root[miss], again)
        return nxt, miss, (state[miss] != root[miss]).astype(np.int64) + (again < 0)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Character classes of all texts in a row, and where each text ends."""
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        cls = self.classes[cp]
        ends = np.cumsum([len(t) for t in texts])
        keep = np.ones(len(cls), bool)
        keep[1:] = (cls[1:] != SPACE) | (cls[:-1] != SPACE)
        first = np.concatenate([[0], ends[:-1]])
        keep[first[first < len(cls)]] = True  # a text's first character follows no other
        return cls[keep], np.concatenate([[0], np.cumsum(keep)])[ends]

    def parse(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (a column per text, a row per language), characters and
        whether the text has a letter."""
        codes, ends = self.codes(texts)
        codes = codes.astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        size = ends - starts
        pieces = -(-size // STRETCH)
        doc = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = starts[doc] + nth * STRETCH
        left = np.minimum(ends[doc] - at, STRETCH)
        shape = (len(self.langs), len(doc))
        root = np.repeat(np.array(self.roots, np.int64), len(doc))
        at, left, follows = np.tile(at, shape[0]), np.tile(left, shape[0]), np.tile(nth > 0, shape[0])
        begun, count = root.copy(), np.zeros(len(root), np.int64)
        state = self._advance(codes, at, left, root, root.copy(), count)
        begins = np.where(follows, np.roll(state, 1), root)
        self._again(codes, at, left, root, begun, begins, np.flatnonzero(begins != begun), state, count)
        self._chains(codes, at, left, root, begins, follows, state, count)
        last = np.append(doc[1:] != doc[:-1], True)[: len(doc)]
        count += (state != root) & np.tile(last, shape[0])
        total = np.zeros((len(self.langs), len(texts)), np.int64)
        for k, row in enumerate(count.reshape(shape)):
            total[k] = np.bincount(doc, row, len(texts))
        letters = np.concatenate([[0], np.cumsum(codes != SPACE)])
        return total, size, letters[ends] > letters[starts]

    def _advance(self, codes, at, left, root, state, count) -> np.ndarray:
        """Where every stretch ends that begins in ``state``; its phrases are added to ``count``."""
        order = np.argsort(-left, kind="stable")
        at, left, root, state, ended = at[order], left[order], root[order], state[order], np.zeros(len(order), np.int64)
        active = len(at) - np.searchsorted(left[::-1], np.arange(1, (int(left[0]) if len(left) else 0) + 1), "left")
        for step, n in enumerate(active):
            state[:n], miss, new = self.step(state[:n], root[:n], codes[at[:n] + step])
            ended[miss] += new
        count[order] += ended
        out = np.empty_like(state)
        out[order] = state
        return out

    def _again(self, codes, at, left, root, begun, begins, lanes, state, count) -> None:
        """Mends ``state`` and ``count`` of stretches that were parsed from ``begun`` and begin in
        ``begins``: both parses are followed until they meet, or to the end of the stretch."""
        old, new, step = begun[lanes], begins[lanes], 0
        while len(lanes):
            c = codes[at[lanes] + step]
            old, miss, n = self.step(old, root[lanes], c)
            count[lanes[miss]] -= n
            new, miss, n = self.step(new, root[lanes], c)
            count[lanes[miss]] += n
            step += 1
            over = left[lanes] == step
            state[lanes[over]] = new[over]
            more = (old != new) & ~over
            lanes, old, new = lanes[more], old[more], new[more]

    def _chains(self, codes, at, left, root, begun, follows, state, count) -> None:
        """Stretches behind one whose two parses never met, one by one; ``count`` holds what was
        counted from ``begun``. Equal stretches (of repeated lines) are parsed once a state."""
        known: dict[tuple, tuple[int, int]] = {}

        def parsed(p: int, entry: int) -> tuple[int, int]:
            run = codes[at[p] : at[p] + left[p]]
            key = (int(root[p]), run.tobytes(), entry)
            if key not in known:
                known[key] = self._follow(run.tolist(), entry, int(root[p]))
            return known[key]

        changed = np.flatnonzero(follows & (np.roll(state, 1) != begun)).tolist()
        for p in changed:
            while p < len(state) and follows[p] and state[p - 1] != begun[p]:
                old, (end, new) = parsed(p, int(begun[p]))[1], parsed(p, int(state[p - 1]))
                count[p] += new - old
                begun[p], state[p] = state[p - 1], end
                p += 1

    def _follow(self, codes: list[int], state: int, root: int) -> tuple[int, int]:
        """The state behind some characters, and the phrases that end on the way."""
        n, one, width = 0, self.moves.one, self.width
        for c in codes:
            to = one(state * width + c)
            if to < 0:
                n += state != root
                to = one(root * width + c)
                if to < 0:
                    n, to = n + 1, root
            state = to
        return state, n

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits a character of each text."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        total, size, lettered = self.parse(texts)
        bits = total * np.array(self.weight)[:, None] / np.maximum(size, 1)
        best = bits.argmin(axis=0)
        least = bits.min(axis=0)
        if len(self.langs) > 1:
            second = np.partition(bits, 1, axis=0)[1]
            score = np.clip(1 - least / np.where(second > 0, second, 1), 0, 1)
        else:
            score = np.ones(len(texts))
        return ([self.langs[b] if x else "und" for b, x in zip(best, lettered, strict=True)],
                np.where(lettered, score, 0.0), np.where(lettered, least, 0.0))


@functools.lru_cache(2)
def _parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(dict(samples))


def learn(docs: DataFrame, train=None, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> tuple:
    """The bounded sample of labelled text per language, from the rows where ``train`` holds."""
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & (F.lit(True) if train is None else train))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                       F.col(id_col).alias("id"), F.xxhash64(id_col).alias("h")).where(F.length("text") > 0)
    langs = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGS).collect()]
    if not langs:
        return ()
    most = min(TRAIN_CHARS, TOTAL_CHARS // len(langs))
    place = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - PIECE, F.lit(0)) + 1) + 1
    rows = rows.where(F.col("lang").isin(langs)).select("lang", "id", "h", F.col("text").substr(place.cast("int"), F.lit(PIECE)).alias("piece"))
    least = Window.partitionBy("lang").orderBy("h", "id", "piece")
    rows = rows.withColumn("k", F.row_number().over(least)).where(F.col("k") <= -(-most // PIECE))
    texts: dict[str, list[str]] = {}
    for r in rows.orderBy("lang", "k").select("lang", "piece").collect():
        texts.setdefault(r["lang"], []).append(r["piece"].lower())
    return tuple((lang, " ".join(t)[:most]) for lang, t in sorted(texts.items()))


def identify(docs: DataFrame, samples: tuple, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``bits`` (normalised phrases) to every row."""
    small_batches(docs.sparkSession)
    schema = StructType(list(docs.schema.fields))
    at = docs.columns.index(text_col)
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("bits", "double")):
        schema = schema.add(name, kind) if name not in docs.columns else schema
    new = ("lang_pred", "score", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(samples)
        for b in batches:
            for lo, hi in slices(b.column(at), 6 << 20):
                part = b.slice(lo, hi - lo)
                made = dict(zip(new, map(pa.array, parser.predict(py_texts(part.column(at)))), strict=True))
                yield pa.RecordBatch.from_arrays([made[n] if n in made else part.column(part.schema.get_field_index(n)) for n in schema.names], schema.names)

    return docs.mapInArrow(run, schema)


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    samples = learn(docs, crc_mod("doc_id", 3) != 1)
    return (identify(docs.select("doc_id", "text"), samples)
            .select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits"))
