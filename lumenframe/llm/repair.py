"""Conversation structure repair: the cheapest edits that make the turns alternate.

The turns of a conversation, in order, become one letter each: the role (system, user, assistant, other)
and what is wrong with the turn (must go, cut short, nothing). Edits cost: keep 0, other role 2, delete 3,
insert an empty turn 2, and 1 more for each turn that stays cut short. The result must read ``(s?(ua)+)?``
in initials. Conversations with the same letters have the same repair, and those that begin alike share
the first layers of the dynamic programme: the distinct signatures are dealt by range and sorted, which is
the depth-first walk of their prefix trie, and a stack holds the layers of the path walked now. Of a
signature only the layers below the prefix it shares with the one before are computed; the answer is read
off at its terminal node. So a task holds the layers of one path, whatever the number of signatures.

Whether a turn repeats an earlier one and the order of turns are found in one shuffle by conversation;
Python reads its sorted rows one by one and holds one letter a turn. Signatures are grouped before the
programme; its answers are joined back, large signatures apart. The repaired text is hashed as its rows
stream by. The text of one conversation is hashed in sequence, which no other machine can share; it is
read in pieces and spilled, so its length does not count against memory.

Ties between edits go to the least string of initials (D, I, K, R). That order is decided by walking the
optimal paths from the start and taking the least letter each time, since a letter leads to one place.

Defined results: null roles, texts, turns and ids count as one space where text is needed; rows of a null id are
one conversation; turns come nulls first and ties by role and text in bytes; a conversation all of whose rows were dropped has zeros, an
empty audit and the hash of the empty text; no rows: no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lumenframe.llm.common import join_counted, table, written

_SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: Letters of a signature: a turn that must go, then roles s, u, a and o (others), capital where the turn is cut short.
GONE = "-"
#: States of the result: nothing yet, after system, after user, after assistant. What each may be followed by.
_WANTS = ("u", "u", "a", "u")
_AFTER = {"s": 1, "u": 2, "a": 3}
_ENDS = (0, 3)
_NEVER = 1 << 30


# ---------------------------------------------------------------- damage and faults


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone): rows with faults planted by a hash of conversation and turn; ``gone`` ones were dropped."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(as_text(conv_col), F.lit(":"), as_text(turn_col)).cast("binary")) % 20
    text = as_text(text_col)
    return rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.when(pick == 4, "user").otherwise(as_text(role_col)).alias("role"),
        F.when(pick == 1, "").when(pick == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (pick == 0).alias("gone"),
        F.explode(F.when(pick == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, gone) with ``fault``: the first of blank, duplicate, truncated, or null; and ``nth``,
    which tells equal rows apart. Rows that were dropped have none and hide no others."""
    dealt = rows.repartition("conv").withColumn("said", ~F.col("gone"))
    earlier = Window.partitionBy("conv", "role", "text", "said").orderBy(F.col("turn").asc_nulls_first())
    body = F.rtrim("text", F.lit(_SPACES))
    fault = (
        F.when(F.col("gone"), None)
        .when(body == "", "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    return dealt.withColumn("nth", F.row_number().over(earlier)).withColumn("fault", fault).drop("said")


def letter(role: Column, fault: Column) -> Column:
    """The signature letter of a turn."""
    initial = F.left(role, F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(F.coalesce(fault.isin("blank", "duplicate"), F.lit(False)), GONE).when(fault == "truncated", F.upper(known)).otherwise(known)


def signatures(turns: DataFrame) -> DataFrame:
    """(conv, signature, gaps, blank, duplicate, truncated, illegal): one row for each conversation of ``faults``."""
    conv = turns.schema["conv"]
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal")
    schema = StructType([StructField("conv", conv.dataType), *StructType.fromDDL("signature string, " + ", ".join(f"{c} long" for c in counts))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind = None
        current, letters, stats, low, high, last_turn, distinct, initial = None, None, None, None, None, None, 0, None

        def end() -> None:
            gaps = high - low + 1 - distinct if distinct else 0
            out.append((current, "".join(letters), gaps, stats["blank"], stats["duplicate"], stats["truncated"], stats["illegal"]))

        for b in batches:
            kind = b.schema.field("conv").type
            cols = [b.column(k).to_pylist() for k in ("conv", "turn", "initial", "gone", "fault", "letter")]
            for c, turn, first, gone, fault, mark in zip(*cols, strict=True):
                if letters is None or c != current:
                    if letters is not None:
                        end()
                    current, letters, initial, distinct, low, high, last_turn = c, [], None, 0, None, None, None
                    stats = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
                if gone:
                    continue
                letters.append(mark)
                if fault is not None:
                    stats[fault] += 1
                if initial is not None and initial + first not in ("su", "ua", "au"):
                    stats["illegal"] += 1
                initial = first
                if turn is not None:
                    low = turn if low is None else low
                    high = turn
                    distinct += turn != last_turn
                    last_turn = turn
            if len(out) >= 10_000:
                yield _table(out, kind, schema.names)
                out = []
        if letters is not None:
            end()
        if out:
            yield _table(out, kind, schema.names)

    ordered = turns.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "nth")
    narrow = ordered.select(
        "conv", "turn", F.left("role", F.lit(1)).alias("initial"), "gone", "fault", letter(F.col("role"), F.col("fault")).alias("letter")
    )
    return narrow.mapInArrow(work, schema)


def _table(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    first, text, *rest = zip(*rows, strict=True)
    columns = [pa.array(first, kind), pa.array(text, pa.string()), *[pa.array(c, pa.int64()) for c in rest]]
    return pa.RecordBatch.from_arrays(columns, names)


# ---------------------------------------------------------------- the programme


def _inserted(costs: list[int]) -> list[int]:
    """A layer after any insertions; three in a row lead nowhere new."""
    out = list(costs)
    for _ in range(3):
        for state in range(4):
            after = _AFTER[_WANTS[state]]
            out[after] = min(out[after], out[state] + INSERT)
    return out


def _moves(mark: str, state: int) -> list[tuple[str, int, int]]:
    out = [("D", state, DELETE)]
    if mark != GONE:
        role, cut = mark.lower(), CUT if mark.isupper() else 0
        if role == _WANTS[state] or (role == "s" and state == 0):
            out.append(("K", _AFTER[role], KEEP + cut))
        out.append(("R", _AFTER[_WANTS[state]], REROLE + cut))
    return out


#: What may become of a turn, by letter and state: (initial of the edit, next state, cost).
MOVES = {mark: [_moves(mark, state) for state in range(4)] for mark in GONE + "suaoSUAO"}


def next_layer(layer: list[int], mark: str) -> list[int]:
    """The least cost of each state after one turn more."""
    out = [_NEVER] * 4
    for cost, moves in zip(layer, MOVES[mark], strict=True):
        for _, after, price in moves:
            out[after] = min(out[after], cost + price)
    return _inserted(out)


def first_layer() -> list[int]:
    return _inserted([0, _NEVER, _NEVER, _NEVER])


def read_off(layers: list[list[int]], signature: str) -> tuple[int, str]:
    """The cost and the least string of edits, from the layers of the path to a terminal node."""
    n = len(signature)
    cost = min(layers[n][s] for s in _ENDS)
    # places that lie on a cheapest path, from the end; a place is a turn and a state, its cost known
    good = [0] * (n + 1)
    for s in _ENDS:
        if layers[n][s] == cost:
            good[n] |= 1 << s
    for k in range(n, -1, -1):
        for _ in range(3):
            for state in range(4):
                after = _AFTER[_WANTS[state]]
                if good[k] >> after & 1 and layers[k][state] + INSERT == layers[k][after]:
                    good[k] |= 1 << state
        if k:
            for state in range(4):
                for _, after, price in MOVES[signature[k - 1]][state]:
                    if good[k] >> after & 1 and layers[k - 1][state] + price == layers[k][after]:
                        good[k - 1] |= 1 << state
    out, k, state = [], 0, 0
    while True:
        here = layers[k][state]
        if k == n and state in _ENDS and here == cost:
            return cost, "".join(out)
        options = []
        if k < n:
            options = [(e, k + 1, a) for e, a, price in MOVES[signature[k]][state] if good[k + 1] >> a & 1 and here + price == layers[k + 1][a]]
        after = _AFTER[_WANTS[state]]
        if good[k] >> after & 1 and here + INSERT == layers[k][after]:
            options.append(("I", k, after))
        edit, k, state = min(options)
        out.append(edit)


def repairs(found: DataFrame) -> DataFrame:
    """(signature, conversations, cost, audit) of every distinct signature."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers, path = [first_layer()], ""
        for b in batches:
            texts, cost, audit = b.column("signature").to_pylist(), [], []
            for signature in texts:
                shared = 0
                for x, y in zip(signature, path, strict=False):
                    if x != y:
                        break
                    shared += 1
                del layers[shared + 1 :]  # up the trie to the last node in common
                for mark in signature[shared:]:
                    layers.append(next_layer(layers[-1], mark))
                path = signature
                c, a = read_off(layers, signature)
                cost.append(c)
                audit.append(a)
            yield pa.RecordBatch.from_arrays(
                [b.column("signature"), b.column("conversations"), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                ["signature", "conversations", "cost", "audit"],
            )

    counted = found.groupBy("signature").agg(F.count(F.lit(1)).alias("conversations"))
    spread = counted.repartitionByRange("signature").sortWithinPartitions("signature")
    return spread.mapInArrow(work, "signature string, conversations long, cost long, audit string")


# ---------------------------------------------------------------- repaired texts

_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (conv, counts, audit) with the hash of the repaired turns of each conversation of ``rows``.

    The plan of a conversation comes before its rows in the sorted stream, so they are not joined.
    """
    schema = StructType([*plan.select("conv", *_COUNTS, "audit").schema, *StructType.fromDDL("repaired_sha256 string")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[tuple] = []
        hashes: list[str] = []
        digest, audit, at, state, some = None, "", 0, 0, False

        def say(role: str, text: str) -> None:
            nonlocal state, some
            digest.update(f"\n{role}:{text}".encode() if some else f"{role}:{text}".encode())
            some, state = True, _AFTER[role[:1]]

        def wanted() -> str:
            return "user" if _WANTS[state] == "u" else "assistant"

        def inserts() -> None:
            nonlocal at
            while audit[at : at + 1] == "I":
                say(wanted(), "")
                at += 1

        def end() -> None:
            if digest is not None:
                inserts()
                hashes.append(digest.hexdigest())

        for b in batches:
            names = ("conv", "role", "text", *_COUNTS, "audit")
            for conv, role, text, *counts, plan_ in zip(*[b.column(k).to_pylist() for k in names], strict=True):
                if plan_ is not None:
                    end()
                    if len(hashes) >= 10_000:
                        yield _batch(heads, hashes, schema, b)
                        heads, hashes = [], []
                    heads.append((conv, *counts, plan_))
                    digest, audit, at, state, some = hashlib.sha256(), plan_, 0, 0, False
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    say(role, text)
                elif edit == "R":
                    say(wanted(), text)
            last = b
        end()
        if heads:
            yield _batch(heads, hashes, schema, last)

    heads = plan.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), *_COUNTS, "audit")
    said = rows.where(~F.col("gone")).select("conv", F.lit(1).alias("kind"), "turn", "role", "text")
    both = heads.unionByName(said, allowMissingColumns=True).repartition("conv")
    ordered = both.sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv", "role", "text", *_COUNTS, "audit").mapInArrow(work, schema)


def _batch(heads: list[tuple], hashes: list[str], schema: StructType, like: pa.RecordBatch) -> pa.RecordBatch:
    *columns, audit = zip(*heads, strict=True)
    kinds = [like.schema.field("conv").type, *[pa.int64()] * len(_COUNTS)]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(audit, pa.string()), pa.array(hashes, pa.string())], schema.names)


def repair(rows: DataFrame) -> DataFrame:
    """The repair of every conversation of ``rows`` (conv, turn, role, text, gone), as ``damaged`` makes them.

    Out: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    found = written(signatures(faults(rows)), "signatures")
    answers = written(repairs(found), "repairs")
    plan = join_counted(found, answers, ["signature"], "conversations")
    return repaired(rows, plan)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


def _sql() -> str:
    """The same by a recursive query over the turns, which carries the best edits of each state along."""
    crc = (
        "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(key)) + 1),"
        " lambda p: ('0x' || substr(hex(encode(key)), 2 * p - 1, 2))::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)),"
        " lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"
    )
    step = lambda s, edit, price, line=None: (
        f"{{'c': {s}.c + {price}, 'a': {s}.a || '{edit}', 't': " + (f"list_append({s}.t, {line})" if line else f"{s}.t") + "}"
    )
    least = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    edit = lambda s, ok, *rest: f"CASE WHEN {ok} THEN {step(s, *rest)} ELSE {{'c': 1000000, 'a': '', 't': []::VARCHAR[]}} END"
    stays, cut = "NOT gone", "CASE WHEN truncated THEN 1 ELSE 0 END"
    keep = lambda s, r: edit(s, f"{stays} AND left(role, 1) = '{r}'", "K", cut, "role || ':' || text")
    rerole = lambda s, r: edit(s, stays, "R", f"2 + {cut}", f"'{r}:' || text")
    row = {
        0: [step("s0", "D", 3)],
        1: [step("s1", "D", 3), keep("s0", "s")],
        2: [step("s2", "D", 3), *[f(s, r) for s in ("s0", "s1", "s3") for f, r in ((keep, "u"), (rerole, "user"))]],
        3: [step("s3", "D", 3), keep("s2", "a"), rerole("s2", "assistant")],
    }
    insert = lambda s, r: step(s, "I", 2, f"'{r}:'")
    never = "{'c': 1000000, 'a': '', 't': []::VARCHAR[]}"
    closed = (
        f"m AS (SELECT * REPLACE ({least('s2', *[insert(s, 'user') for s in ('s0', 's1', 's3')])} AS s2) FROM n)"
        f" SELECT conv_id, rn, s0, s1, s2, {least('s3', insert('s2', 'assistant'))} AS s3 FROM m"
    )
    gone = "fault IN ('blank', 'duplicate')"
    return f"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
p AS (SELECT *, {crc} % 20 AS pick FROM k),
d AS (SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
  CASE pick WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM p, (SELECT unnest([0, 1]) AS copy) WHERE pick <> 0 AND (copy = 0 OR pick = 3)),
q AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) AS nth, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM q),
f AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
  left(lag(role) OVER (PARTITION BY conv_id ORDER BY rn), 1) || left(role, 1) AS pair FROM o),
g AS (SELECT conv_id, rn, role, text, coalesce({gone}, false) AS gone, coalesce(fault = 'truncated', false) AS truncated FROM f),
dp AS (SELECT * FROM (WITH n AS (SELECT DISTINCT conv_id, 0::BIGINT AS rn, {{'c': 0, 'a': '', 't': []::VARCHAR[]}} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM k), {closed})
 UNION ALL SELECT * FROM (WITH n AS (SELECT dp.conv_id, g.rn, {least(*row[0])} AS s0, {least(*row[1])} AS s1, {least(*row[2])} AS s2, {least(*row[3])} AS s3
  FROM dp JOIN g ON g.conv_id IS NOT DISTINCT FROM dp.conv_id AND g.rn = dp.rn + 1), {closed})),
t AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT dp.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, b.c::BIGINT AS cost, b.a AS audit, sha256(array_to_string(b.t, chr(10))) AS repaired_sha256
FROM (SELECT *, {least('s0', 's3')} AS b FROM dp) dp LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE dp.rn = coalesce(t.n, 0)"""


OP12_SQL = _sql()
