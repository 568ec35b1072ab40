"""Operator 13: collocations by HAT-trie counting.

Texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and
tabs into words (A-Z in lower case). Per language all phrases of one to three
words are counted; a phrase of two or three words with ``a >= min_count`` is a
candidate. A cut after its first k words has ``l`` and ``r``, the counts of both
parts, and the score ``floor(1000000 * a * a / (l * r))``; the lowest-scoring
cut counts (of equals the first). A candidate that lies inside a longer one
which has at least ``absorb`` percent of its count is dropped.

Counting. A task inserts the three words that start at each place into a trie
over word ids: the root leads by the first word's id to hash containers, and a
container of more than ``BURST`` entries bursts into containers by the second
word's id. At ``SPILL`` entries whole subtrees leave, the largest ones
first, until half of the entries are left. They leave as sorted runs, cut by
the hash of their first two words; each such prefix partition merges its runs
on its own, sums the counts of the phrases' beginnings on the way and keeps
what reaches ``min_count``. Nothing below it can be a part of a candidate, so
only the kept counts meet in joins. A frequent word's phrases are spread by
their second word, and a phrase in a third of all texts is one entry a run.

Defined results: null texts are empty; a null language is ``und``, together
with rows of that very name; repeated rows count again, ids play no part; a
piece without words gives nothing; long texts are counted whole; an empty
table gives an empty result. Other columns are ignored. Scores and counts are
exact: products are decimals of 38 digits, which hold counts to 10^16. Within a
task a word is known by a 64-bit hash, between tasks by its bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from bizlens.llm.common import documents, mix64, partitions, slices, small_batches, stored
from bizlens.llm.textbytes import BASE, INVERSE, LOWER, powers, text_bytes

MIN_COUNT, TOP, ABSORB = 10, 2000, 50
FAN, BURST, SPILL, PART_TEXT = 64, 16_384, 400_000, 16 << 20
BITS = 21  # of a word id within a task or a partition
CUT, GAP = np.zeros(256, bool), np.zeros(256, bool)
CUT[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
GAP[[0x20, 0x09]] = True


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=total[1:])
    return mix64((total[end] - total[start]) * powers(INVERSE, len(data) + 1)[start] ^ mix64((end - start).astype(np.uint64)))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (in lower-cased bytes), and a number that
    words of one piece share."""
    n = len(data)
    cut = CUT[data]
    ink = ~(cut | GAP[data])
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | first[1:n]
    done = ink.copy()
    done[:-1] &= ~ink[1:] | first[1:n]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(done) + 1, np.cumsum(cut | first[:n])[start]


class HatTrie:
    """Counts of places by the up to three words that start there. A node is a
    hash container of packed words, or, burst, a list of nodes by word id."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.names: list[bytes] = []  # of each id, with its hash and language
        self.hashes: list[int] = []
        self.langs: list[int] = []
        self.tongues: dict[str, int] = {}
        self.ids: dict[int, int] = {}  # by the hash of language and word
        self.root: list = [Counter() for _ in range(FAN)]  # by the first word
        self.entries = 0

    def insert(self, langs: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        if not len(data):
            return
        data = LOWER[data]
        start, end, piece = tokens(data, offsets)
        if not len(start):
            return
        text = np.searchsorted(offsets, start, "right") - 1
        names, of = np.unique(np.array(langs, object), return_inverse=True)
        lang = of[text]
        salt = mix64(np.array([zhash(x) for x in names], np.uint64))
        h, where, word = np.unique(_hash(data, start, end) ^ salt[lang], return_index=True, return_inverse=True)
        known = list(map(self.ids.get, h.tolist()))
        raw, tongue = data.tobytes(), [self.tongues.setdefault(x, len(self.tongues)) for x in names]
        for k in [k for k, i in enumerate(known) if i is None]:
            w, x = where[k], int(h[k])
            known[k] = self.ids[x] = len(self.names)
            self.names.append(raw[start[w] : end[w]])
            self.hashes.append(x)
            self.langs.append(tongue[lang[w]])
        a = np.array(known, np.int64)[word]
        b, c = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        b[:-1] = np.where(piece[1:] == piece[:-1], a[1:] + 1, 0)
        c[:-2] = np.where(piece[2:] == piece[:-2], a[2:] + 1, 0)
        self._add(self.root, (a << 2 * BITS) | (b << BITS) | c, 2 * BITS)

    def _add(self, nodes: list, keys: np.ndarray, shift: int) -> None:
        """``keys`` to the nodes of one word's ids."""
        slot = (keys >> shift & FAN - 1).astype(np.uint8)
        keys = keys[np.argsort(slot, kind="stable")]
        ends = np.cumsum(np.bincount(slot, minlength=FAN)).tolist()
        for k, (s, e) in enumerate(zip([0, *ends], ends)):
            if s == e:
                continue
            node = nodes[k]
            if isinstance(node, list):
                self._add(node, keys[s:e], shift - BITS)
                continue
            self.entries -= len(node)
            node.update(keys[s:e].tolist())
            self.entries += len(node)
            if len(node) > BURST and shift == 2 * BITS:
                children: list = [Counter() for _ in range(FAN)]
                for key, n in node.items():
                    children[key >> BITS & FAN - 1][key] = n
                nodes[k] = children

    def spill(self, everything: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(key, count) of the subtrees that leave, sorted."""
        trees = []
        for at, node in enumerate(self.root):
            trees += [(len(child), node, k) for k, child in enumerate(node)] if isinstance(node, list) else [(len(node), self.root, at)]
        trees.sort(key=lambda t: -t[0])
        keep = 0 if everything else self.entries // 2
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, nodes, k in trees:
            if self.entries <= keep:
                break
            keys.append(np.fromiter(nodes[k].keys(), np.int64, size))
            counts.append(np.fromiter(nodes[k].values(), np.int64, size))
            nodes[k] = Counter()
            self.entries -= size
        key = np.concatenate(keys)
        order = np.argsort(key)
        return key[order], np.concatenate(counts)[order]


def zhash(name: str) -> int:
    import zlib

    return zlib.crc32(name.encode()) + 1


def _sums(group: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run of equal values, and the sum of its counts."""
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    return at, (np.add.reduceat(count, at) if len(at) else count)


def _runs(trie: HatTrie, key: np.ndarray, count: np.ndarray, parts: int) -> pa.RecordBatch:
    """Spilled subtrees as one sorted run for each prefix partition and
    language: word table, columns of word numbers, counts."""
    names, hashes = trie.names, trie.hashes
    mask = (1 << BITS) - 1
    first = key >> 2 * BITS
    at, total = _sums(first, count)
    more = (key >> BITS & mask) > 0
    key, count = np.concatenate([first[at] << 2 * BITS, key[more]]), np.concatenate([total, count[more]])
    a, b = key >> 2 * BITS, key >> BITS & mask
    h = np.array(hashes, np.uint64)
    part = (mix64(h[a] + np.where(b > 0, mix64(h[b - 1]), np.uint64(0))) % np.uint64(parts)).astype(np.int64)
    langs = list(trie.tongues)
    group = part * len(langs) + np.array(trie.langs, np.int64)[a]
    order = np.lexsort((key, group))
    group, key, count = group[order], key[order], count[order]
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else []
    rows = []
    for s, e in zip(at, [*at[1:], len(group)]):
        here = np.stack([(key[s:e] >> 2 * BITS) + 1, key[s:e] >> BITS & mask, key[s:e] & mask])
        if 20 * (e - s) > len(names):
            used = np.zeros(len(names) + 1, bool)
            used[here] = used[0] = True  # number 0 says that no word follows
            ids, local = np.flatnonzero(used), (np.cumsum(used) - 1)[here]
        else:
            ids, local = np.unique(np.append(0, here), return_inverse=True)
            local = local[1:].reshape(here.shape)
        body = np.concatenate([local.astype(np.uint32).ravel().view(np.uint8).reshape(-1, 4).T.ravel(), count[s:e].view(np.uint8).reshape(-1, 8).T.ravel()])
        table = b" ".join([names[i] for i in (ids[1:] - 1).tolist()])
        rows.append((int(group[s] // len(langs)), langs[group[s] % len(langs)], e - s, zstandard.compress(table, 1), zstandard.compress(body.tobytes(), 1)))
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()))],
                           names=["part", "lang", "n", "words", "run"])


def _count(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie()
        for batch in batches:
            for s, e in slices(batch.column(1)):
                data, offsets = text_bytes(batch.column(1).slice(s, e - s))
                trie.insert(batch.column(0).slice(s, e - s).to_pylist(), data, offsets)
                if len(trie.names) >= 1 << BITS - 2:
                    yield _runs(trie, *trie.spill(True), parts)
                    trie.clear()
                while trie.entries >= SPILL:
                    yield _runs(trie, *trie.spill(), parts)
        yield _runs(trie, *trie.spill(True), parts)
    return run


def merged(rows: list[tuple[int, bytes, bytes]], least: int) -> tuple[list[tuple], int]:
    """Runs (length, words, run) of one partition and language: (words, count)
    of at least ``least``, and the number of all words."""
    ids: dict[bytes, int] = {}
    cols, counts = [], []
    for n, table, body in rows:
        table = zstandard.decompress(table)
        to = np.array([-1, *(ids.setdefault(w, len(ids)) for w in table.split(b" "))], np.int64) + 1
        body = np.frombuffer(zstandard.decompress(body), np.uint8)
        local = np.ascontiguousarray(body[: 12 * n].reshape(4, 3 * n).T).view(np.uint32).reshape(3, n)
        cols.append(to[local])
        counts.append(np.ascontiguousarray(body[12 * n :].reshape(8, n).T).view(np.int64).reshape(n))
    a, b, c = np.concatenate(cols, axis=1)
    count = np.concatenate(counts)
    width = len(ids) + 1
    pair = a * width + b
    order = np.argsort((pair << BITS) | c) if width < 1 << BITS - 1 else np.lexsort((c, pair))
    a, b, c, count, pair = a[order], b[order], c[order], count[order], pair[order]
    at, f = _sums(pair, count)
    one = b[at] == 0
    words = int(f[one].sum())
    names = [None, *(w.decode() for w in ids)]
    out = []
    for k in np.flatnonzero(f >= least):
        i = at[k]
        out.append((names[a[i]], names[b[i]], None, int(f[k])))
    new = np.zeros(len(pair), bool)
    new[at] = True
    new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    f = np.add.reduceat(count, at) if len(at) else count
    for k in np.flatnonzero((f >= least) & (c[at] > 0)):
        i = at[k]
        out.append((names[a[i]], names[b[i]], names[c[i]], int(f[k])))
    return out, words


def _merge(least: int):
    def run(rows: pa.Table) -> pa.Table:
        langs = rows.column("lang").to_pylist()
        cols = [rows.column(n).to_pylist() for n in ("n", "words", "run")]
        out = []
        for lang in sorted(set(langs)):
            found, words = merged([r for x, *r in zip(langs, *cols) if x == lang], least)
            out += [(lang, *f) for f in found]
            if words:
                out.append((lang, None, None, None, words))
        types = (pa.string(),) * 4 + (pa.int64(),)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, types)], names=["lang", "w1", "w2", "w3", "f"])
    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT) -> DataFrame:
    """``lang``, ``w1``, ``w2``, ``w3``, ``f``: phrases of one to three words
    (missing words are null) that occur ``min_count`` times or more; rows
    without words hold parts of a language's number of words."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(partitions(spark), -(-total // PART_TEXT))
    runs = texts.mapInArrow(_count(parts), "part long, lang string, n long, words binary, run binary")
    return runs.groupBy("part").applyInArrow(_merge(min_count), "lang string, w1 string, w2 string, w3 string, f long")


def _score(a: Column, left: Column, right: Column) -> Column:
    wide = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", wide(wide(F.lit(1_000_000) * a.cast("decimal(19,0)")) * a.cast("decimal(19,0)")), wide(left.cast("decimal(19,0)") * right.cast("decimal(19,0)")))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, absorb: int = ABSORB, top: int = TOP) -> DataFrame:
    """The first ``top`` candidates of each language by score, count and phrase:
    ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counts = stored(phrase_counts(docs, text_col, lang_col, min_count), "phrases")
    n = counts.where("w1 is null").groupBy("lang").agg(F.sum("f").alias("n"))
    one = counts.where("w1 is not null and w2 is null").select("lang", "w1", "f")
    two = counts.where("w2 is not null and w3 is null").select("lang", "w1", "w2", F.col("f").alias("a"))
    three = counts.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    def look(df: DataFrame, part: DataFrame, words: list[str], value: str, name: str) -> DataFrame:
        keys = [c for c in part.columns if c not in ("lang", value)]
        part = part.select("lang", *[F.col(k).alias(w) for k, w in zip(keys, words)], F.col(value).alias(name))
        return df.join(part, ["lang", *words])

    inside = (three.select("lang", "w1", "w2", "a").unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
              .groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer")))
    pairs = two.join(inside, ["lang", "w1", "w2"], "left").where(f"longer is null or 100 * longer < {absorb} * a")
    pairs = look(look(pairs, one, ["w1"], "f", "l"), one, ["w2"], "f", "r").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    triples = look(look(three, one, ["w1"], "f", "l1"), two, ["w2", "w3"], "a", "r1")
    triples = look(look(triples, two, ["w1", "w2"], "a", "l2"), one, ["w3"], "f", "r2")
    cut = F.least(*[F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)])
    triples = triples.withColumn("cut", cut).select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = pairs.unionByName(triples).withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP13_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^ \\t]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0b\\x0c\\r]')) AS p FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, w[i] AS w1, NULL AS w2, NULL AS w3 FROM places
  UNION ALL SELECT lang, w[i], w[i + 1], NULL FROM places WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, w[i], w[i + 1], w[i + 2] FROM places WHERE i + 2 <= len(w)),
f AS (SELECT lang, w1, w2, w3, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE w2 IS NULL GROUP BY lang),
c AS (SELECT * FROM f WHERE f >= {MIN_COUNT} AND w2 IS NOT NULL),
inside AS (
  SELECT lang, w1, w2, max(f) AS longer FROM (
    SELECT lang, w1, w2, f FROM c WHERE w3 IS NOT NULL UNION ALL SELECT lang, w2, w3, f FROM c WHERE w3 IS NOT NULL) GROUP BY lang, w1, w2),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM c JOIN f x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 IS NULL JOIN f y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 IS NULL
  LEFT JOIN inside i ON i.lang = c.lang AND i.w1 = c.w1 AND i.w2 = c.w2
  WHERE c.w3 IS NULL AND (longer IS NULL OR 100 * longer < {ABSORB} * c.f)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 1
  FROM c JOIN f x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 IS NULL JOIN f y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3 AND y.w3 IS NULL
  WHERE c.w3 IS NOT NULL
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, x.f, y.f, 2
  FROM c JOIN f x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 AND x.w3 IS NULL JOIN f y ON y.lang = c.lang AND y.w1 = c.w3 AND y.w2 IS NULL
  WHERE c.w3 IS NOT NULL),
scored AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
