"""Repair of conversations: the cheapest edits after which roles alternate as they should, found by iterative deepening.

Each conversation is read as a stream of short codes, a row each. A depth-first search tries edits in ASCII order of their initials
under increasing bounds of cost, with a table of states that failed, so the first path accepted is the answer. A long conversation is
searched in blocks, from and to each state of the role order; what goes on from block to block is a path for each state.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common_arrow import ARROW
from tripstream.llm.importance import CRC32, CRC32_TABLE

#: States of the role order (system? (user assistant)+)?, by the initial of the last role; "" is the start.
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ROLE = {"u": "user", "a": "assistant"}
STATES = ("", "s", "u", "a")
#: In place of a state to end in: any that may end a conversation.
END = "end"
DELETE, INSERT, REROLE, CUT_SHORT = 3, 2, 2, 1
#: Rows that are searched at once.
BLOCK = 32
#: A row with a fault that only deletion mends.
GONE = "d"
WHITE = " \t\n\x0b\x0c\r"


def wanted(state: str) -> str:
    """The initial that an inserted or changed role has after a state."""
    return "a" if state == "u" else "u"


class Search:
    """Cheapest edits of a block, a letter a row: an initial s, u, a or x (any other), upper-case where the text is cut short, or GONE."""

    def __init__(self, rows: str, to: str):
        self.rows, self.to, self.failed = rows, to, {}
        kept = [r.lower() for r in rows if r != GONE]
        last = {END: "a", "a": "a", "u": "u"}.get(to)
        # Lower bounds: what faults cost at least, and 2 for each of a set of disjoint neighbours that don't fit.
        self.pairs = [0] * (len(kept) + 2)
        for j in range(len(kept) - 1, -1, -1):
            fits = (kept[j], kept[j + 1]) in NEXT if j + 1 < len(kept) else last in (None, kept[j])
            self.pairs[j] = max(self.pairs[j + 1] + 2 * (kept[j] == "x"), 0 if fits else 2 + self.pairs[j + 2])
        self.kept, self.faults, self.before = kept, [0] * (len(rows) + 1), [0] * (len(rows) + 1)
        for i in range(len(rows) - 1, -1, -1):
            self.faults[i] = self.faults[i + 1] + (DELETE if rows[i] == GONE else CUT_SHORT * rows[i].isupper())
        for i, r in enumerate(rows):
            self.before[i + 1] = self.before[i] + (r != GONE)

    def least(self, i: int, state: str) -> int:
        j = self.before[i]
        if j < len(self.kept):
            clash = 0 if (state, self.kept[j]) in NEXT else 2 + self.pairs[j + 1]
        else:
            clash = 0 if self.accepts(state) else INSERT
        return self.faults[i] + max(self.pairs[j], clash)

    def accepts(self, state: str) -> bool:
        return state in ("", "a") if self.to == END else state == self.to

    def reachable(self, state: str) -> bool:
        if self.to == "s":
            return state == "s" or (state == "" and "s" in self.kept)
        return self.to != "" or state == ""

    def path(self, i: int, state: str, budget: int) -> str | None:
        """The first accepted edits from row i on that cost no more than the budget."""
        if i == len(self.rows) and self.accepts(state):
            return ""
        if self.least(i, state) > budget or self.failed.get((i, state), -1) >= budget:
            return None
        new = wanted(state)
        row = self.rows[i] if i < len(self.rows) else ""
        late = CUT_SHORT * row.isupper()
        edits = [("I", i, new, INSERT)]
        if row:
            edits.insert(0, ("D", i + 1, state, DELETE))
            if (state, row.lower()) in NEXT:
                edits.append(("K", i + 1, row.lower(), late))
            if row != GONE:
                edits.append(("R", i + 1, new, REROLE + late))
        for initial, at, then, cost in edits:
            rest = self.path(at, then, budget - cost) if cost <= budget else None
            if rest is not None:
                return initial + rest
        self.failed[i, state] = budget
        return None

    def cheapest(self, state: str) -> tuple[int, str] | None:
        if not self.reachable(state):
            return None
        bound = self.least(0, state)
        while (found := self.path(0, state, bound)) is None:
            bound += 1
        return bound, found


@functools.lru_cache(maxsize=20_000)
def searched(rows: str, to: str, states: tuple[str, ...]) -> dict[str, tuple[int, str]]:
    """From each state the cheapest edits to one; they share the table of what failed."""
    search = Search(rows, to)
    return {s: found for s in states if (found := search.cheapest(s))}


class Paths:
    """The cheapest edits of a conversation so far, for each state that it may be in."""

    def __init__(self):
        self.sure: list[str] = []
        self.tails: dict[str, tuple[int, str]] = {"": (0, "")}

    def take(self, rows: str, last: bool) -> None:
        found = {}
        for to in (END,) if last else STATES:
            ways = searched(rows, to, tuple(self.tails))
            options = [(self.tails[s][0] + cost, self.tails[s][1] + edits) for s, (cost, edits) in ways.items()]
            if options:
                found[to] = min(options)
        common = os.path.commonprefix([t for _, t in found.values()])
        self.sure.append(common)
        self.tails = {s: (cost, t[len(common):]) for s, (cost, t) in found.items()}

    def ended(self) -> tuple[int, str]:
        cost, tail = self.tails[END]
        return cost, "".join([*self.sure, tail])


class Conversation:
    """Faults and edits of one conversation, whose rows come in order."""

    def __init__(self, conv):
        self.conv, self.paths, self.rows, self.key = conv, Paths(), [], None
        self.initial = self.first = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, key, blank: bool, cut_short: bool, repeated: bool) -> None:
        repeated = repeated or key == self.key
        self.key = key
        if turn is not None and (turn != self.turn or self.first is None):
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None:
            self.illegal += (self.initial, initial) not in (("s", "u"), ("u", "a"), ("a", "u"))
        self.initial = initial
        self.blank += blank
        self.duplicate += not blank and repeated
        cut_short = cut_short and not (blank or repeated)
        self.truncated += cut_short
        if len(self.rows) == BLOCK:
            self.paths.take("".join(self.rows), last=False)
            self.rows.clear()
        letter = initial if initial in ("s", "u", "a") else "x"
        self.rows.append(GONE if blank or repeated else letter.upper() if cut_short else letter)

    def result(self) -> tuple:
        self.paths.take("".join(self.rows), last=True)
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.paths.ended())


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def keyed(messages: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text and sha (of the text) of messages; a null role or text is one space."""
    spaced = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = messages.select(F.col(f"`{conversation}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), *spaced)
    return rows.withColumn("sha", F.unhex(F.sha2(F.col("text"), 256)))


def in_order(frame: DataFrame) -> DataFrame:
    """Conversations as streams of rows, each in one task; what says something about rows (kind below 2) comes before them."""
    return frame.repartition("conv").sortWithinPartitions("conv", F.col("kind") > 0, "turn", "role", "sha", "kind")


def later_copies(rows: DataFrame) -> DataFrame:
    """conv, turn, role and sha of rows whose role and text an earlier turn of the conversation has too."""
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    keys = rows.select("conv", "turn", "role", "sha").distinct()
    firsts = keys.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("sha").alias("s")).agg(
        F.min(when).alias("first"), F.count("*").alias("n")
    ).where("n > 1")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s"))
    return keys.join(firsts, same).where(~when.eqNullSafe(F.col("first"))).select("conv", "turn", "role", "sha")


def audits(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """For each conversation in conversations (conv) or rows (as keyed gives them) its faults and cheapest edits."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    blank = trimmed == ""
    none = F.lit(False)
    codes = rows.select("conv", "turn", "role", "sha", F.lit(2).alias("kind"), blank.alias("blank"),
                        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut_short"))
    copies = later_copies(rows).select("*", F.lit(1).alias("kind"), none.alias("blank"), none.alias("cut_short"))
    names = conversations.select("conv").distinct().select(
        "conv", *(F.lit(None).cast(codes.schema[c].dataType).alias(c) for c in ("turn", "role", "sha")),
        F.lit(0).alias("kind"), none.alias("blank"), none.alias("cut_short"),
    )
    conv_type = rows.schema["conv"].dataType
    kinds = [ARROW[conv_type.simpleString()], *[pa.int64()] * 6, pa.string()]
    titles = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(results):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*results, strict=True), kinds, strict=True)], names=titles)

        now, copy, results = None, None, []
        for batch in batches:
            for conv, turn, role, sha, kind, blank, cut_short in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        results.append(now.result())
                    now, copy = Conversation(conv), None
                key = (turn, role, sha)
                if kind == 1:
                    copy = key
                elif kind == 2:
                    now.add(turn, role, key, blank, cut_short, key == copy)
            if len(results) > 1000:
                yield made(results)
                results = []
        if now is not None:
            results.append(now.result())
        if results:
            yield made(results)

    stream = in_order(codes.unionByName(copies).unionByName(names)).select("conv", "turn", "role", "sha", "kind", "blank", "cut_short")
    return stream.mapInArrow(run, f"conv {conv_type.simpleString()}, {RESULT}")


def edited(rows: Iterator[tuple[str, str]], edits: str) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of each row that is there after the edits; takes as many rows as the edits use up."""
    state = ""
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = ROLE[wanted(state)]
        state = role[:1]
        yield edit, role, text


def repaired(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    conversations: DataFrame | None = None, digests: bool = False,
) -> DataFrame:
    """The messages of each conversation after its cheapest repair: conversation, n (from 0), edit, role and text.

    With digests, instead a row for each conversation (also for those that only `conversations` has, by the same column): gaps (turns missing
    between the first and the last), blank, duplicate and truncated (rows by their first fault), illegal (neighbouring roles
    that don't follow each other), cost, audit (the initials of the edits, in order) and repaired_sha256 (of the lines role:text).

    Roles must come as (system? (user assistant)+)?, by their initials. Keep costs nothing, Rerole (to user or assistant) and Insert (of a user's
    or assistant's empty text) 2, Delete 3; a row that stays cut short costs 1 more. Rows that are blank, or whose role and text an earlier
    row has, must be deleted. Of equally cheap edits, the ASCII-least initials count. Order is by turn, nulls first, then role, then the
    text's SHA-256; repeated rows follow each other. A null or empty role or text is one space or empty; other roles are never
    kept. Rows without a conversation are one conversation. Empty tables give no rows; other columns are left out.

    Copies are found by grouping short keys, so nothing that a conversation repeats is gathered. A conversation's rows pass through
    one task as a stream, since a digest is of one sequence; held are a block of rows, the edits so far and a batch.
    """
    rows = keyed(messages, conversation, turn, role, text)
    all_ids = rows if conversations is None else rows.select("conv").union(conversations.select(F.col(f"`{conversation}`").alias("conv")))
    found = audits(rows, all_ids)
    result = [c.split()[0] for c in RESULT.split(", ")]
    told = found.select("conv", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"),
                        F.lit(None).cast("binary").alias("sha"), F.lit(0).alias("kind"), F.struct(*result).alias("found"))
    said = rows.select("*", F.lit(2).alias("kind"), F.lit(None).cast(told.schema["found"].dataType).alias("found"))
    stream = in_order(told.unionByName(said)).select("conv", "role", "text", "kind", "found")
    conv = f"conv {rows.schema['conv'].dataType.simpleString()}"
    out = stream.mapInArrow(digested if digests else rewritten, f"{conv}, {RESULT}, repaired_sha256 string" if digests else f"{conv}, n bigint, edit string, role string, text string")
    return out.withColumnRenamed("conv", conversation)


def conversations_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, dict, Iterator[tuple[str, str, str]]]]:
    """For each conversation its name, what was found, and its messages after the edits, to be read before the next."""
    def rows():
        for batch in batches:
            names, (roles, texts, kinds, found) = batch.column(0), (c.to_pylist() for c in batch.columns[1:])
            for i, row in enumerate(zip(roles, texts, kinds, found, strict=True)):
                yield names.slice(i, 1), *row

    stream = rows()
    for name, _, _, kind, found in stream:
        if kind == 0:
            yield name, found, edited(((r, t) for _, r, t, _, _ in stream), found["audit"])


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, found, messages in conversations_of(batches):
        sha, begun = hashlib.sha256(), False
        for _, role, text in messages:
            sha.update(f"{'\n' if begun else ''}{role}:{text}".encode())
            begun = True
        yield pa.RecordBatch.from_arrays([name, *(pa.array([v]) for v in found.values()), pa.array([sha.hexdigest()])],
                                         names=["conv", *found, "repaired_sha256"])


def rewritten(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    for name, _, messages in conversations_of(batches):
        held: list[tuple] = []
        done = 0
        for message in messages:
            held.append(message)
            if len(held) == size:
                yield numbered(name, done, held)
                done, held = done + size, []
        if held:
            yield numbered(name, done, held)


def numbered(name: pa.Array, first: int, messages: list[tuple[str, str, str]]) -> pa.RecordBatch:
    columns = [pa.concat_arrays([name] * len(messages)), pa.array(range(first, first + len(messages)), pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.string()) for c in zip(*messages, strict=True))], names=["conv", "n", "edit", "role", "text"])


def damaged(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conversation, turn, role and text of messages, of which some are dropped, emptied, cut short, repeated or given to the user, by a CRC
    of conversation and turn. A null is one space (in the CRC too), but conversation and turn themselves stay null."""
    name, at, who, what = (F.col(f"`{c}`") for c in (conversation, turn, role, text))
    spaced = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spaced(name), F.lit(":"), spaced(at)).cast("binary")) % 20
    changed: Column = F.when(fate == 1, "").when(fate == 2, F.translate(spaced(what), ".!?", "")).otherwise(spaced(what))
    rows = messages.select(name.alias("conv"), at.alias("turn"), F.when(fate == 4, "user").otherwise(spaced(who)).alias("role"), changed.alias("text"),
                           F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"))
    times = F.explode(F.array_repeat(F.lit(0), F.col("times")))
    return rows.select(F.col("conv").alias(conversation), F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text), times.alias("copy")).drop("copy")


def op11_repair(spark, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired(damaged(conversations), conversations=conversations, digests=True)


def _least(*options: str) -> str:
    return f"least({', '.join(options)})"


def _plus(state: str, cost: str, edit: str) -> str:
    """A path's text, its cost in eight digits and then its edits, after one more edit; so paths compare as texts."""
    return f"(lpad((substr({state}, 1, 8)::INT + {cost})::VARCHAR, 8, '0') || substr({state}, 9) || '{edit}')"


def _step() -> str:
    """From the paths b, s, u and a (to each state, inserts included) those that use up a row r."""
    keep = {"b": None, "s": "b", "u": _least("b", "s", "a"), "a": "u"}
    change = {"b": None, "s": None, "u": _least("b", "s", "a"), "a": "u"}
    found = []
    for state in "bsua":
        options = [_plus(state, str(DELETE), "D")]
        if keep[state]:
            options.append(f"CASE WHEN NOT gone AND initial = '{state}' THEN {_plus(keep[state], 'late', 'K')} ELSE '90000000' END")
        if change[state]:
            options.append(f"CASE WHEN NOT gone THEN {_plus(change[state], f'{REROLE} + late', 'R')} ELSE '90000000' END")
        found.append(f"{_least(*options)} AS {state}")
    return ", ".join(found)


def _with_inserts(start: str) -> str:
    u = _least("u", *(_plus(x, str(INSERT), "I") for x in "bsa"))
    return f"SELECT * EXCLUDE (a), {_least('a', _plus('u', str(INSERT), 'I'))} AS a FROM (SELECT * EXCLUDE (u), {u} AS u FROM ({start}))"


_CRC = f"xor({CRC32.format('key')}, 4294967295::BIGINT)"
_START = "SELECT conv_id, 0 AS n, '00000000' AS b, '90000000' AS s, '90000000' AS u, '90000000' AS a FROM (SELECT DISTINCT conv_id FROM conversations)"

OP11_SQL = rf"""
WITH RECURSIVE {CRC32_TABLE},
fate AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS f
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations), crc),
kept AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
    FROM fate WHERE f <> 0),
placed AS (
    SELECT *, row_number() OVER w AS i, left(role, 1) AS initial, trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
           lag(left(role, 1)) OVER w AS before, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
    FROM kept WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
faults AS (
    SELECT *, bare = '' OR again AS gone,
           CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           CASE WHEN bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS late FROM placed),
paths AS (
    {_with_inserts(_START)}
    UNION ALL
    {_with_inserts(f"SELECT p.conv_id, p.n + 1 AS n, {_step()} FROM paths p JOIN faults r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.n + 1")}),
ends AS (
    SELECT conv_id, least(b, a) AS best FROM paths p
    WHERE n = (SELECT count(*) FROM faults r WHERE r.conv_id IS NOT DISTINCT FROM p.conv_id)),
edits AS (
    SELECT conv_id, unnest(range(1, length(best) - 7)) AS k, substr(best, 8 + k, 1) AS e,
           length(replace(substr(best, 9, k), 'I', '')) AS i, length(replace(substr(best, 9, k), 'D', '')) AS line FROM ends),
lines AS (
    SELECT d.conv_id, line, e, r.role, coalesce(CASE WHEN e <> 'I' THEN r.text END, '') AS text,
           coalesce(max(CASE WHEN line = 1 AND e = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY d.conv_id), 0) AS led
    FROM edits d LEFT JOIN faults r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i AND e <> 'I' WHERE e <> 'D'),
written AS (
    SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (line - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY line) AS said
    FROM lines GROUP BY conv_id),
sums AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, substr(best, 1, 8)::BIGINT AS cost,
       substr(best, 9) AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN written w ON w.conv_id IS NOT DISTINCT FROM e.conv_id
"""
