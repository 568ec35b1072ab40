"""Operator 11: conversation structure repair by a grammar-compressed DP.

A conversation should read ``(system? (user assistant)+)?`` by the initials of
its roles. Edits: keep a row (0), give it the role user or assistant (2),
delete it (3; a must for blank and duplicate rows), insert an empty user or
assistant row (2); a truncated row that stays adds 1. The cheapest edits are
found, of equals those whose initials (K, R, D, I) come first in ASCII order.

Method. A row is one of twelve symbols: role (s, u, a, other) and fault (none,
truncated, must go). Reading it is a 4 x 4 min-plus matrix over the places in
the pattern (start, after system, after user, after assistant), each cell a
cost and its audit. A task's symbol sequences are compressed together by
Re-Pair: the most frequent pair of neighbours becomes a rule, again and again.
One matrix a rule, the product of its two parts' matrices, is made bottom-up
and serves all conversations of the task; a sequence is the product of what is
left of it. An audit of n rows has n row letters and ends with one, so none is
a prefix of another and the order of equals survives concatenation; inserts at
the end are added last.

At scale the rows of one conversation are spread over tasks by ranges of their
order, a task gives one matrix a conversation (``BATCH`` symbols at most), and
the matrices of a conversation are multiplied in order. Equal rows are counted,
not listed. The digest of the repaired text is taken in one streaming pass in
order (SHA-256 can't be split); the audit is one value and as long as the
conversation, so its rows are bounded by the size of a value (about 10^8).

Defined results: a null conversation id is a conversation; null turns come
first; a null role or text is one space (so the role is neither of the three
and the text blank); rows of equal turn are ordered by role and text, repeated
rows are duplicates of the first; other roles by their first letter only;
conversations without rows give zeros, an empty audit and the digest of the
empty text; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from bizlens.llm.common import partitions, small_batches, stored

#: Symbols by role s, u, a, other: as it is, truncated, must be deleted.
SYMBOLS = "suao" "SUAO" "0123"
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BATCH, RULES, LEAST_PAIRS = 1 << 18, 128, 4
NO_CELL = -1
LEGAL = {"su", "ua", "au"}
Cell = tuple[int, str] | None
Matrix = list[list[Cell]]


def _expected(state: int) -> int:
    """Where one more user or assistant row leads."""
    return ASSISTANT if state == USER else USER


def symbol_matrix(symbol: int) -> Matrix:
    role, fault = symbol % 4, symbol // 4
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        at = p
        for inserts in range(3):  # a third one comes back to a place already reached
            edits = [(DELETE, "D", at)]
            if fault < 2:
                extra = TRUNCATED * fault
                edits.append((REROLE + extra, "R", _expected(at)))
                if (role == 0 and at == START) or (role == 1 and at != USER) or (role == 2 and at == USER):
                    edits.append((KEEP + extra, "K", SYSTEM if role == 0 else _expected(at)))
            for cost, letter, q in edits:
                cell = (INSERT * inserts + cost, "I" * inserts + letter)
                if out[p][q] is None or cell < out[p][q]:
                    out[p][q] = cell
            at = _expected(at)
    return out


def times(x: Matrix, y: Matrix) -> Matrix:
    out: Matrix = []
    for row in x:
        line: list[Cell] = []
        for q in range(4):
            best: Cell = None
            for r in range(4):
                a, b = row[r], y[r][q]
                if a is None or b is None:
                    continue
                cost = a[0] + b[0]
                if best is None or cost < best[0]:
                    best = (cost, a[1] + b[1])
                elif cost == best[0]:
                    best = min(best, (cost, a[1] + b[1]))
            line.append(best)
        out.append(line)
    return out


def product(parts: list[Matrix]) -> Matrix:
    """In halves, so that long audits are copied a few times only."""
    while len(parts) > 1:
        parts = [times(parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def finish(matrix: Matrix | None) -> tuple[int, str]:
    """Cost and audit of a whole conversation, with the inserts at its end."""
    if matrix is None:
        return 0, ""
    ends = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    return min((cell[0] + INSERT * len(ends[q]), cell[1] + ends[q]) for q, cell in enumerate(matrix[START]) if cell is not None)


def re_pair(sequences: list[np.ndarray], rules: int = RULES) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """The sequences over symbols and rules, and the pair of each rule (rule k
    is the number ``len(SYMBOLS) + k``). A pair never spans two sequences."""
    sizes = [len(s) for s in sequences]
    text = np.concatenate([np.append(s, -1) for s in sequences]).astype(np.int64) if sequences else np.zeros(0, np.int64)
    made: list[tuple[int, int]] = []
    while len(made) < rules and len(text) > 1:
        width = len(SYMBOLS) + len(made)
        ok = (text[:-1] >= 0) & (text[1:] >= 0)
        if not ok.any():
            break
        count = np.bincount(text[:-1][ok] * width + text[1:][ok], minlength=1)
        best = int(count.argmax())
        if count[best] < LEAST_PAIRS:
            break
        x, y = divmod(best, width)
        at = np.flatnonzero((text[:-1] == x) & (text[1:] == y))
        if x == y:  # every other place of a run
            run = np.flatnonzero(np.append(True, np.diff(at) != 1))
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
        text[at] = width
        text = np.delete(text, at + 1)
        made.append((x, y))
    ends = np.flatnonzero(text == -1)
    begins = np.append(0, ends[:-1] + 1) if len(ends) else ends
    return [text[b:e] for b, e in zip(begins, ends)] if sizes else [], made


class Grammar:
    """One matrix for each symbol and rule of a batch of sequences."""

    def __init__(self, sequences: list[str]) -> None:
        code = np.full(128, -1, np.int64)
        code[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
        self.short, self.rules = re_pair([code[np.frombuffer(s.encode(), np.uint8)] for s in sequences])
        self.matrices = [symbol_matrix(k) for k in range(len(SYMBOLS))]
        for x, y in self.rules:
            self.matrices.append(times(self.matrices[x], self.matrices[y]))

    def solve(self, k: int) -> Matrix:
        return product([self.matrices[s] for s in self.short[k].tolist()])


def initial(symbol: str) -> str:
    return "suao"[SYMBOLS.index(symbol) % 4]


def illegal_pairs(symbols: str) -> int:
    who = [initial(s) for s in symbols]
    return sum(a + b not in LEGAL for a, b in zip(who, who[1:]))


# -- rows -------------------------------------------------------------------------

WHITE = r"[\x20\x09-\x0D]"


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` after the planted damage, with ``n`` (how often)."""
    space = F.lit(" ")
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))
    spot = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("harm", F.crc32(spot.cast("binary")) % 20).where("harm <> 0")
    return rows.select(
        "conv", "turn", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("harm") == 3, 2).otherwise(1).cast("long").alias("n"))


def _place(turn: str = "turn") -> Column:
    return F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"))


def judged(rows: DataFrame) -> DataFrame:
    """Equal rows of one turn counted; ``symbol`` of the first of them and
    ``rest``, that of the others."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("said", F.sha2("text", 256))
    rows = stored(rows, "turns")
    # only what is said at several turns needs its first place
    again = (rows.groupBy("conv", "role", "said").agg(F.min(_place()).alias("first"), F.count("*").alias("turns")).where("turns > 1")
             .select(F.col("conv").alias("conv1"), F.col("role").alias("role1"), F.col("said").alias("said1"), "first"))
    rows = rows.join(again, F.col("conv").eqNullSafe(F.col("conv1")) & (F.col("role") == F.col("role1")) & (F.col("said") == F.col("said1")), "left")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    seen = F.col("first").isNotNull() & (_place() > F.col("first"))
    cut = ~F.col("text").rlike(rf"[.!?]{WHITE}*\z")
    fault = F.when(blank, "blank").when(seen, "duplicate").when(cut, "truncated").otherwise("")
    who = F.substring("role", 1, 1)
    of = F.when(who == "s", 0).when(who == "u", 1).when(who == "a", 2).otherwise(3)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), 8).when(F.col("fault") == "truncated", 4).otherwise(0)
    return rows.withColumn("fault", fault).select(
        "conv", "turn", "role", "text", "n", "fault", F.substring(F.lit(SYMBOLS), of + kind + 1, F.lit(1)).alias("symbol"), F.substring(F.lit(SYMBOLS), of + 9, F.lit(1)).alias("rest"))


def tallies(rows: DataFrame) -> DataFrame:
    """Counts of a conversation, one row a turn first."""
    one = lambda name: F.sum(F.when(F.col("fault") == name, F.lit(1).cast("long")).otherwise(0))
    more = lambda *names: F.sum(F.when(F.col("fault").isin(*names), F.col("n") - 1).otherwise(0))
    per = rows.groupBy("conv", "turn").agg((one("blank") + more("blank")).alias("blank"), (one("duplicate") + more("", "duplicate", "truncated")).alias("duplicate"), one("truncated").alias("truncated"))
    gaps = F.when(F.count("turn") > 0, F.max("turn") - F.min("turn") + 1 - F.count("turn")).otherwise(0)
    return per.groupBy("conv").agg(gaps.cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (conv, symbol, rest, n): one matrix a conversation, or
    several in order where it is long."""
    part = TaskContext.get().partitionId()
    done: list[list] = []  # [conv, symbols], the last one still open
    held, seq = 0, 0

    def flush() -> pa.RecordBatch:
        nonlocal done, held, seq
        distinct = {s: k for k, s in enumerate(dict.fromkeys("".join(s) for _, s in done))}
        grammar = Grammar(list(distinct))
        solved = {s: grammar.solve(k) for s, k in distinct.items()}
        cols: list[list] = [[] for _ in range(8)]
        for conv, s in done:
            s = "".join(s)
            cells = [c or (NO_CELL, "") for row in solved[s] for c in row]
            for col, v in zip(cols, (conv, part, seq, initial(s[0]), initial(s[-1]), illegal_pairs(s), [c[0] for c in cells], [c[1] for c in cells])):
                col.append(v)
            seq += 1
        done, held = [], 0
        types = (conv_type, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["conv", "part", "seq", "first", "last", "illegal", "costs", "audits"])

    conv_type = None
    for batch in batches:
        conv_type = batch.column(0).type
        for conv, symbol, rest, n in zip(*(c.to_pylist() for c in batch.columns)):
            while n:
                if not done or done[-1][0] != conv:
                    if held >= BATCH:
                        yield flush()
                    done.append([conv, []])
                elif held >= BATCH:
                    yield flush()
                    done.append([conv, []])
                if symbol is not None:
                    done[-1][1].append(symbol)
                    held, n, symbol = held + 1, n - 1, None
                else:
                    k = min(n, max(BATCH - held, 1))
                    done[-1][1].append(rest * k)
                    held, n = held + k, n - k
    if done:
        yield flush()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for parts in batch.column(1).to_pylist():
            parts.sort(key=lambda p: (p["part"], p["seq"]))
            cells = [[c if c[0] != NO_CELL else None for c in zip(p["costs"], p["audits"])] for p in parts]
            cost, audit = finish(product([[c[k : k + 4] for k in range(0, 16, 4)] for c in cells]))
            illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
            out.append((illegal, cost, audit))
        illegal, cost, audit = zip(*out) if out else ((), (), ())
        yield pa.record_batch([batch.column(0), pa.array(illegal, pa.int64()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())], names=["conv", "illegal", "cost", "audit"])


def solved(rows: DataFrame) -> DataFrame:
    """``conv``, ``illegal``, ``cost``, ``audit``."""
    spark = rows.sparkSession
    order = ["conv", "turn", "role"]
    spread = rows.repartitionByRange(partitions(spark), *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    conv = spread.schema["conv"].dataType.simpleString()
    parts = spread.select("conv", "symbol", "rest", "n").mapInArrow(
        _solve, f"conv {conv}, part int, seq long, first string, last string, illegal long, costs array<long>, audits array<string>")
    whole = parts.groupBy("conv").agg(F.collect_list(F.struct(*parts.columns[1:])).alias("parts"))
    return whole.mapInArrow(_fold, f"conv {conv}, illegal long, cost long, audit string")


class _Repaired:
    """Digest (or text) of a conversation's rows, told its audit first."""

    def __init__(self, audit: str, texts: bool) -> None:
        self.audit, self.at, self.state, self.first = audit, 0, START, True
        self.digest, self.lines = hashlib.sha256(), [] if texts else None

    def _line(self, line: str) -> None:
        self.digest.update(((("" if self.first else "\n") + line)).encode())
        self.first = False
        if self.lines is not None:
            self.lines.append(line)

    def _given(self, text: str) -> None:
        self.state = _expected(self.state)
        self._line(f"{'user' if self.state == USER else 'assistant'}:{text}")

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._given("")
            self.at += 1

    def row(self, role: str, text: str, n: int) -> None:
        for _ in range(n):
            self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.state = SYSTEM if role[0] == "s" else _expected(self.state)
                self._line(f"{role}:{text}")
            elif letter == "R":
                self._given(text)


def _digests(texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, out, kind = None, None, [], None

        def close() -> None:
            now.inserts()
            out.append((conv, now.digest.hexdigest(), now.lines))

        def results() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [(), (), ()]
            arrays = [pa.array(cols[0], kind), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.list_(pa.string()))]
            return pa.record_batch(arrays[: 2 + texts], names=["conv", "repaired_sha256", "lines"][: 2 + texts])

        for batch in batches:
            kind = batch.column(0).type
            for c, head, role, text, n in zip(*(x.to_pylist() for x in batch.columns)):
                if head:
                    if now is not None:
                        close()
                    now, conv = _Repaired(text, texts), c
                else:
                    now.row(role, text, n)
            yield results()
            out.clear()
        if now is not None:
            close()
            yield results()
    return run


def digests(rows: DataFrame, audits: DataFrame, texts: bool = False) -> DataFrame:
    """``conv``, ``repaired_sha256`` and, on request, ``lines`` (the repaired
    ``role:text`` rows): a conversation's audit comes first, then its rows in order."""
    null = F.lit(None)
    heads = audits.select("conv", F.lit(True).alias("head"), null.cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("n"))
    both = heads.unionByName(rows.select("conv", F.lit(False).alias("head"), "turn", "role", "text", "n"))
    both = both.repartition("conv").sortWithinPartitions("conv", F.desc("head"), "turn", "role", "text").select("conv", "head", "role", "text", "n")
    conv = both.schema["conv"].dataType.simpleString()
    return both.mapInArrow(_digests(texts), f"conv {conv}, repaired_sha256 string" + (", lines array<string>" if texts else ""))


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = True, texts: bool = False) -> DataFrame:
    """One row per conversation: faults, cost, audit and digest of the repaired
    rows (with ``texts`` the rows themselves as ``lines``)."""
    spark = turns.sparkSession
    small_batches(spark)
    if damage:
        rows = damaged(turns, conv, turn, role, text)
    else:
        rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                            F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("n"))
    rows = stored(judged(rows), "judged")
    audits = stored(solved(rows), "audits")
    made = digests(rows, audits, texts)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    tables = [turns.select(F.col(conv).alias("conv")), tallies(rows), audits, made]
    types = {**{n: "long" for n in numbers}, "audit": "string", "repaired_sha256": "string", **({"lines": "array<string>"} if texts else {})}
    # every table has one row a conversation, but the first: one grouping instead of joins
    union = None
    for t in tables:
        t = t.select("conv", *[(F.col(c) if c in t.columns else F.lit(None)).cast(k).alias(c) for c, k in types.items()])
        union = t if union is None else union.unionByName(t)
    best = union.groupBy("conv").agg(*[F.max(c).alias(c) for c in types])
    return best.select(
        F.col("conv").alias(conv), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"), *(["lines"] if texts else []))


def op11_repair(spark, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
