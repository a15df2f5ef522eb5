"""Conversation structure repair by scalar big-integer weights (operator 11).

A conversation is a path through a small DAG: at each row it may keep, rerole or delete the row, and between rows it may insert
an empty one.  The states say which role came last (nothing, s, u, a), so that the role initials always fit ``(s?(ua)+)?``.
Every path weighs one integer.  Its high digits are the cost.  Below them each audit letter has one octal digit at its place in
the audit (D < I < K < R as in ASCII), and places after the last letter hold zero.  So the ordinary integer minimum takes the
cheapest path and, of those, the ASCII-least audit.  Two paths of one state and cost never have audits of which one begins the
other, as the longer one would have paid for its further inserts; hence a path's future cannot turn the order round.

Rows of a conversation pass through its task once, in order, and are not gathered: each state carries its weight and the running
hash of its repaired text.  Integers stay short because every ``BLOCK`` rows the digits that all paths have reached are cut off
and replaced by their rank.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podelta.llm.common import arrow_schema, spark_schema, to_batch

#: Fixed values of the contract.
SPACE = " \t\n\v\f\r"
FAULTS = 20
LETTERS = {"D": 1, "I": 2, "K": 3, "R": 4}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: states: nothing yet, after s, after u, after a; role -> (its initial, states it may follow, state it leads to)
ROLES = {"system": ("s", (0,), 1), "user": ("u", (0, 1, 3), 2), "assistant": ("a", (2,), 3)}
FINAL = (0, 3)
#: Rows between two cuts of the weights.
BLOCK = 32


class Repair:
    """Cheapest repair of one conversation, fed row by row."""

    def __init__(self) -> None:
        self.top = 0  # bits of the audit digits below the cost
        self.rows = 0
        #: per state (weight, letters in it, hash of the repaired text, digits cut off before as (earlier, digits, letters))
        self.paths: list[tuple | None] = [(0, 0, hashlib.sha256(), None), None, None, None]

    def _cut(self) -> None:
        """Room for a block of rows; digits that every path has are replaced by one digit, the rank of their value."""
        live = [p for p in self.paths if p]
        common, longest = min(p[1] for p in live), max(p[1] for p in live)
        head = lambda p: (p[0] & ((1 << self.top) - 1)) >> (self.top - 3 * common)
        rank = {h: r for r, h in enumerate(sorted({head(p) for p in live}), 1)}
        top = 3 * (1 + longest - common + 3 * BLOCK + 2)
        out: list[tuple | None] = []
        for p in self.paths:
            if p:
                rest = (p[0] & ((1 << (self.top - 3 * common)) - 1)) >> (self.top - 3 * longest)
                weight = (p[0] >> self.top << top) + (rank[head(p)] << (top - 3)) + (rest << (top - 3 * (1 + longest - common)))
                p = (weight, p[1] - common + 1, p[2], (p[3], head(p), common))
            out.append(p)
        self.paths, self.top = out, top

    def _edge(self, into: list, source: int, target: int, cost: int, letter: str, piece: str | None) -> None:
        path = self.paths[source]
        if path is None:
            return
        weight = path[0] + (cost << self.top) + (LETTERS[letter] << (self.top - 3 * (path[1] + 1)))
        if into[target] is None or weight < into[target][0]:
            into[target] = (weight, path[1] + 1, path[2], path[3], piece and ("\n" if source else "") + piece)

    def _settle(self, into: list) -> None:
        """Only chosen paths hash their new text."""
        for state, path in enumerate(into):
            if path is not None and len(path) == 5:
                digest = path[2]
                if path[4]:
                    digest = digest.copy()
                    digest.update(path[4].encode("utf-8", "surrogatepass"))
                into[state] = (path[0], path[1], digest, path[3])
        self.paths = into

    def _insert(self) -> None:
        """Empty user and assistant rows; a third one in a row would only come back to a state at a higher cost."""
        for _ in range(2):
            into = list(self.paths)
            for role in ("user", "assistant"):
                _, sources, target = ROLES[role]
                for source in sources:
                    self._edge(into, source, target, INSERT, "I", f"{role}:")
            self._settle(into)

    def add(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        """The next row; ``must_go`` rows can only be deleted."""
        if self.rows % BLOCK == 0:
            self._cut()
        self.rows += 1
        self._insert()
        into: list = [None] * 4
        for state in range(4):
            self._edge(into, state, state, DELETE, "D", None)
        for name, (initial, sources, target) in ROLES.items() if not must_go else ():
            for source in sources:
                if role[:1] == initial:
                    self._edge(into, source, target, TRUNCATED * truncated, "K", f"{role}:{text}")
                elif name != "system":
                    self._edge(into, source, target, REROLE + TRUNCATED * truncated, "R", f"{name}:{text}")
        self._settle(into)

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired text)."""
        if not self.rows:
            return 0, "", self.paths[0][2].hexdigest()
        self._insert()
        weight, n, digest, earlier = min(self.paths[s] for s in FINAL if self.paths[s])
        chunks, at = [], (earlier, (weight & ((1 << self.top) - 1)) >> (self.top - 3 * n), n)
        while at is not None:
            chunks.append(format(at[1], "o").zfill(at[2])[at[0] is not None:] if at[2] else "")  # after a cut the rank comes first
            at = at[0]
        letters = "".join(reversed(chunks)).translate({ord(str(d)): c for c, d in LETTERS.items()})
        return weight >> self.top, letters, digest.hexdigest()


class Conversation:
    """Faults, gaps and repair of one conversation, fed row by row in turn order."""

    def __init__(self) -> None:
        self.repair = Repair()
        self.low = self.high = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        body = text.rstrip(SPACE)
        blank = not body
        duplicate = again and not blank
        truncated = not blank and not duplicate and body[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.repair.add(role, text, blank or duplicate, truncated)

    def row(self, key) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, here): rows after damage by crc32(``conv:turn``) % 20; null roles and texts become one space.

    A dropped row stays with ``here`` false and neither role nor text, so that its conversation is not lost.
    """
    space = F.lit(" ")
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                                F.coalesce(F.col(role).cast("string"), space).alias("role"),
                                F.coalesce(F.col(text).cast("string"), space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("fault", F.crc32(name.cast("binary")) % FAULTS)
    hit = lambda n: F.col("fault") == n
    rows = rows.select("conv", "turn", F.when(hit(0), None).when(hit(4), "user").otherwise(F.col("role")).alias("role"),
                       F.when(hit(0), None).when(hit(1), "").when(hit(2), F.regexp_replace("text", "[.!?]", ""))
                       .otherwise(F.col("text")).alias("text"), (~hit(0)).alias("here"),
                       F.explode(F.array_repeat(F.lit(0), F.when(hit(3), 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with ``again`` (role and text came earlier in the conversation), each conversation in one partition and in order.

    Order is by turn (null first), then role and text.  One shuffle by conversation serves both sorts, and both can spill.
    """
    seen = Window.partitionBy("conv", "here", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return (rows.repartition("conv").withColumn("again", F.row_number().over(seen) > 1)
            .sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"))


def repair(rows: DataFrame, conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation of ``rows`` (as ``damage`` gives them): faults, gaps, cost, audit, hash of the repaired text.

    Null conversation ids form one conversation.  Null turns come first and make no gap.  Empty texts are blank, roles other than
    the three are reroled or deleted, repeated rows are duplicates.  A conversation without rows has zeros, an empty audit and the
    hash of the empty text; an empty table gives no rows.  Texts of any length are hashed as they pass.
    """
    schema = arrow_schema(conversations, conv, gaps=pa.int64(), blank=pa.int64(), duplicate=pa.int64(), truncated=pa.int64(),
                          illegal=pa.int64(), cost=pa.int64(), audit=pa.string(), repaired_sha256=pa.string())

    def run(batches) -> Iterator[pa.RecordBatch]:
        key, at, out = None, None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                for name, turn, role, text, here, again in zip(*(c.to_pylist() for c in part.columns)):
                    if at is None or name != key:
                        out += [at.row(key)] if at else []
                        key, at = name, Conversation()
                    if here:
                        at.add(turn, role, text, again)
                if len(out) >= 2048:
                    yield to_batch(out, schema)
                    out = []
        out += [at.row(key)] if at else []
        if out:
            yield to_batch(out, schema)

    return ordered(rows).select("conv", "turn", "role", "text", "here", "again").mapInArrow(run, spark_schema(schema))


def repaired_rows(rows: DataFrame, repairs: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, place, edit, role, text): the repaired conversations, by applying each audit to the rows it was made for.

    The n-th K, R or D stands for the n-th row.  What stays has roles (s)uaua..., so a reroled or inserted row's role follows
    from its distance to the end, where an assistant stands.
    """
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = rows.where("here").withColumn("at", F.row_number().over(order)).select("conv", "at", "role", "text")
    letters = repairs.where("audit <> ''").select(F.col(conv).alias("conv"), F.posexplode(F.split("audit", "")).alias("step", "edit"))
    so_far = Window.partitionBy("conv").orderBy("step")
    every = Window.partitionBy("conv")
    stays = (F.col("edit") != "D").cast("int")
    letters = (letters.where("edit <> ''")
               .select("conv", "step", "edit", F.sum((F.col("edit") != "I").cast("int")).over(so_far).alias("row"),
                       F.sum(stays).over(so_far).alias("place"), F.sum(stays).over(every).alias("all")).where("edit <> 'D'"))
    fresh = F.when((F.col("all") - F.col("place")) % 2 == 0, "assistant").otherwise("user")
    return (letters.alias("l").join(numbered.alias("n"), F.col("l.conv").eqNullSafe(F.col("n.conv")) & (F.col("l.edit") != "I")
                                    & (F.col("l.row") == F.col("n.at")), "left")
            .select(F.col("l.conv").alias(conv), F.col("place").cast("long").alias("place"), "edit",
                    F.when(F.col("edit") == "K", F.col("n.role")).otherwise(fresh).alias("role"),
                    F.when(F.col("edit") == "I", "").otherwise(F.col("n.text")).alias("text")))
