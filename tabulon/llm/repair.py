"""Conversation structure repair by Dijkstra on the lattice of (turn index, grammar state).

A conversation's role initials must read ``(s?(ua)+)?``.  Rows are kept (0), given another role (3) or deleted (4, as blank and repeated
ones must be), turns are inserted (3), and a truncated row that stays costs 3.  States are what was read last: nothing, s, u or a;
all targets of an edit are forced by the state, so an audit (the edits' initials) names one repair.

1. Rows are range-partitioned and sorted by conversation, turn, role and text, and take their place from that order: a long conversation
   lies in many tasks.  First occurrences are a pre-aggregated minimum of places joined back.
2. Every row becomes one letter (role initial and fault); letters are strung together by range, then by conversation.  A conversation's string is
   as long as the audit it is answered with.
3. Dijkstra with the key (cost, audit) runs over each string, implicit in its letters, and stops at the first popped accepting end node.  Strings
   longer than ``WINDOW`` are searched in windows, each seeded with all states' keys at its beginning; among keys of one turn and cost none begins another, so
   comparing them by rank keeps their order, and an audit is never held more than once a state.
4. The audit leads its conversation's rows through one sorted stream, which hashes what is repaired.  SHA-256 is a chain, so one conversation's texts
   pass one task, in bounded memory; nothing of them is held.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import slices, stored, table

#: Turns that one search spans.
WINDOW = 512
SPACE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Letter of a row: 4 * role initial (other, s, u, a) + fault (none, blank, duplicate, truncated) behind "A".
_ALPHABET = "ABCDEFGHIJKLMNOP"


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, alive): rows damaged by the crc32 of ``conv:turn`` modulo 20; dropped rows stay with ``alive`` false.

    0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4 makes its role user.  Nulls read as one space.
    """
    named = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named(conv), F.lit(":"), named(turn)).cast("binary")) % 20
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(named(role)).alias("role"),
                        F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate(named(text), ".!?", "")).otherwise(named(text)).alias("text"), kind.alias("kind"))
    return rows.withColumn("alive", F.col("kind") != 0).withColumn("nth", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))).drop("kind", "nth")


def _letter(repeated: Column) -> Column:
    """The letter of a row."""
    shown = F.rtrim("text", F.lit(SPACE))
    fault = F.when(shown == "", 1).when(repeated, 2).when(~F.substring(shown, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    initial = F.when(F.col("role") == "", 0).otherwise(F.expr("locate(substring(role, 1, 1), 'sua')"))
    return F.substring(F.lit(_ALPHABET), (initial * 4 + fault + 1).cast("int"), F.lit(1))


def lettered(rows: DataFrame) -> DataFrame:
    """(key, conv, gaps, letters) of every conversation, from stored ``rows`` with their places."""
    live = rows.where("alive")
    first = live.groupBy("digest").agg(F.min("place").alias("first"))
    letters = live.select("key", "place", "role", "text", "digest").join(first, "digest").select("key", "place", _letter(F.col("place") > F.col("first")).alias("letter"))
    strung = lambda c: F.array_join(F.transform(F.array_sort(c), lambda x: x["s"]), "")
    runs = letters.groupBy("key", F.shiftright("place", 33).alias("range")).agg(strung(F.collect_list(F.struct("place", F.col("letter").alias("s")))).alias("s"))
    whole = runs.groupBy("key").agg(strung(F.collect_list(F.struct("range", "s"))).alias("letters"))
    turns = live.where("turn IS NOT NULL").groupBy("key", "turn").agg(F.lit(1).alias("n")).groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    every = rows.groupBy("key").agg(F.min("conv").alias("conv"))
    return every.join(whole, "key", "left").join(turns, "key", "left").select("key", "conv", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), F.coalesce("letters", F.lit("")).alias("letters"))


def _edits(letter: str, state: int):
    """(cost, initial, state) of a row's edits."""
    initial, fault = divmod(ord(letter) - 65, 4)
    yield DELETE, "D", state
    if fault in (1, 2):
        return
    more = TRUNCATED if fault == 3 else 0
    target = _ASSISTANT if state == _USER else _USER
    if initial == target or (initial == _SYSTEM and state == _START):
        yield KEEP + more, "K", initial
    yield REROLE + more, "R", target


def _searched(letters: str, seeds: dict[int, tuple[int, str]], last: bool) -> dict[int, tuple[int, str, int]]:
    """Dijkstra over ``letters`` from ``seeds`` {state: (cost, key)}: {state at the end: (cost, key, seed)}.

    In the ``last`` window it stops at the first accepting end node; before, when all states at the end are popped.
    """
    end, done, found = len(letters), set(), {}
    heap = [(cost, key, 0, state, state) for state, (cost, key) in seeds.items()]
    heapq.heapify(heap)
    while heap:
        cost, key, at, state, seed = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == end:
            if last and state in (_START, _ASSISTANT):
                return {state: (cost, key, seed)}
            found[state] = cost, key, seed
            if len(found) == 4:
                break
        else:
            for price, initial, to in _edits(letters[at], state):
                if (at + 1, to) not in done:
                    heapq.heappush(heap, (cost + price, key + initial, at + 1, to, seed))
        to = _ASSISTANT if state == _USER else _USER
        if (at, to) not in done:
            heapq.heappush(heap, (cost + INSERT, key + "I", at, to, seed))
    return found


def repaired(letters: str, window: int = WINDOW) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, of equally cheap ones the audit that sorts first."""
    seeds, back = {_START: (0, "")}, []
    begins = range(0, max(1, len(letters)), window)
    for begin in begins:
        found = _searched(letters[begin : begin + window], seeds, begin == begins[-1])
        back.append({state: (seed, key[len(seeds[seed][1]) :]) for state, (_, key, seed) in found.items()})
        # keys by rank: a key that another one of this turn begins differs from it by inserts at its end alone
        seeds, base, token, rank = {}, None, "", 0x100
        for key, state, cost in sorted((key, state, cost) for state, (cost, key, _) in found.items()):
            if base is None or not key.startswith(base):
                base, token, rank = key, chr(rank), rank + 1
            seeds[state] = cost, token + key[len(base) :]
    (state, (cost, _)), parts = next(iter(seeds.items())), []
    for step in reversed(back):
        state, part = step[state]
        parts.append(part)
    return cost, "".join(reversed(parts))


def faults(letters: str) -> tuple[int, int, int, int]:
    """(blank, duplicate, truncated, illegal) of a conversation."""
    count = [sum(map(letters.count, _ALPHABET[k::4])) for k in (1, 2, 3)]
    roles = "".join("xsua"[(ord(c) - 65) // 4] for c in letters)
    return *count, sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(roles, roles[1:])))


def _audited(lettered: DataFrame) -> DataFrame:
    kind = dict(lettered.dtypes)["conv"]

    def run(batches):
        for b in slices(batches):
            rows = [(*faults(x), *repaired(x)) for x in b.column(3).to_pylist()]
            columns = list(zip(*rows)) or [()] * 6
            found = [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 5 + [pa.string()])]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *found], names=["key", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    return lettered.mapInArrow(run, f"key string, conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


class _Repair:
    """The repaired text of one conversation, hashed as its rows come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.begun = audit, 0, _START, hashlib.sha256(), False

    def put(self, role: str, text: str, state: int) -> None:
        self.sha.update((("\n" if self.begun else "") + role + ":" + text).encode())
        self.begun, self.state = True, state

    def forced(self) -> tuple[str, int]:
        return ("assistant", _ASSISTANT) if self.state == _USER else ("user", _USER)

    def inserts(self) -> None:
        while self.audit.startswith("I", self.at):
            role, state = self.forced()
            self.put(role, "", state)
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.put(role, text, " sua".index(role[0]))
        elif edit == "R":
            to, state = self.forced()
            self.put(to, text, state)

    def digest(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of already damaged or raw rows.

    ``turns`` may have a column ``alive``; where it is false the row only names its conversation.  Rows are ordered by turn (nulls first), role and
    text; null roles and texts read as one space.  Rows without a conversation id are one conversation.  A role that begins with none of s, u
    and a, an empty one too, can't be kept.  A conversation without live rows has zeros, an empty audit and the empty string's hash.
    Extra columns are not read; an empty table gives an empty result.
    """
    alive = F.col("alive") if "alive" in turns.columns else F.lit(True)
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"), alive.alias("alive"))
    rows = rows.withColumn("key", F.when(F.col("conv").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("conv").cast("string"))))
    rows = rows.withColumn("digest", F.sha2(F.concat_ws("\x1f", "key", F.length("role").cast("string"), "role", "text"), 256))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "repair-rows")
    heads = stored(_audited(stored(lettered(rows), "repair-letters")), "repair-audits")

    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    none = {n: F.lit(None).cast(t).alias(n) for n, t in heads.dtypes + [("place", "long"), ("role", "string"), ("text", "string")]}
    stream = heads.select("key", *names, none["place"], none["role"], none["text"]).unionByName(
        rows.where("alive").select("key", *[none[n] for n in names], "place", "role", "text"))
    stream = stream.repartition("key").sortWithinPartitions("key", F.col("place").asc_nulls_first()).select(*names, "place", "role", "text")

    def run(batches):
        head, work = None, None
        for b in slices(batches):
            out = []
            columns = [c.to_pylist() for c in b.columns]
            for *values, place, role, text in zip(*columns):
                if place is None:
                    if head is not None:
                        out.append((*head, work.digest()))
                    head, work = values, _Repair(values[7])
                else:
                    work.row(role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds(b))], names=[*names, "repaired_sha256"])
        if head is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*head, work.digest()), kinds(b))], names=[*names, "repaired_sha256"])

    def kinds(b):
        return [*[b.schema.field(i).type for i in range(len(names))], pa.string()]

    schema = f"conv {dict(heads.dtypes)['conv']}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return stream.mapInArrow(run, schema).withColumnRenamed("conv", "conv_id")


def query(spark, sf_dir):
    return repair(damaged(table(spark, sf_dir, "conversations")), "conv")


def _grown(value: str, cost: str, initial: str) -> str:
    """SQL of a value (nine digits of cost, then the audit) with one more edit; null stays null."""
    return f"(lpad((substr({value}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({value}, 10) || '{initial}')"


def _relaxed(e: str, s: str, u: str, a: str) -> dict[str, str]:
    """SQL of the states' values with inserts at this place; u first, then a."""
    return {"u": f"least({u}, {_grown(e, '3', 'I')}, {_grown(s, '3', 'I')}, {_grown(a, '3', 'I')})", "a": f"least({a}, {_grown('u2', '3', 'I')})"}


_OPEN = "CASE WHEN fault IN (1, 2) THEN NULL ELSE {} END"
_MORE = "CASE fault WHEN 3 THEN 3 ELSE 0 END"
_KEPT = lambda value, initial: f"CASE WHEN initial = '{initial}' THEN {_OPEN.format(_grown(value, _MORE, 'K'))} END"
_TOLD = lambda value: _OPEN.format(_grown(value, f"3 + {_MORE}", "R"))

SQL = rf"""
WITH RECURSIVE
tbl AS (SELECT list(c ORDER BY k) AS t FROM (SELECT k, list_reduce(list_prepend(k::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(k))),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crc AS (SELECT s.*, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(k, '')]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM src s CROSS JOIN tbl),
dam AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM crc, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, rtrim(text, E' \t\n\x0b\f\r') AS shown, left(role, 1) AS initial FROM dam),
row_faults AS (SELECT *, CASE WHEN shown = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 2 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM num),
stats AS (SELECT conv_id, count(*) AS rows_left, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM row_faults GROUP BY conv_id),
pairs AS (SELECT conv_id, count(*) AS illegal FROM (SELECT conv_id, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS p FROM row_faults) WHERE p NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
fold AS (
  SELECT conv_id, 0::BIGINT AS n, '000000000' AS e, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM ids
  UNION ALL
  SELECT f.conv_id, f.n + 1, {_grown('f.e', '4', 'D')}, least({_grown('f.s', '4', 'D')}, {_KEPT('f.e', 's')}),
    least({_grown('u2', '4', 'D')}, {_KEPT('f.e', 'u')}, {_KEPT('f.s', 'u')}, {_KEPT('a2', 'u')}, {_TOLD('f.e')}, {_TOLD('f.s')}, {_TOLD('a2')}),
    least({_grown('a2', '4', 'D')}, {_KEPT('u2', 'a')}, {_TOLD('u2')})
  FROM (SELECT *, {_relaxed('e', 's', 'u', 'a')['a']} AS a2 FROM (SELECT *, {_relaxed('e', 's', 'u', 'a')['u']} AS u2 FROM fold)) f
  JOIN row_faults r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.n = f.n + 1),
ended AS (SELECT f.conv_id, least(e, a, {_grown('least(u, ' + _grown('e', '3', 'I') + ', ' + _grown('s', '3', 'I') + ')', '3', 'I')}) AS v
  FROM fold f WHERE f.n = coalesce((SELECT st.rows_left FROM stats st WHERE st.conv_id IS NOT DISTINCT FROM f.conv_id), 0)),
audits AS (SELECT conv_id, substr(v, 1, 9)::BIGINT AS cost, substr(v, 10) AS audit FROM ended),
walk AS (
  SELECT conv_id, 0 AS p, 0::BIGINT AS n, '' AS last, []::VARCHAR[] AS told, audit FROM audits
  UNION ALL
  SELECT w.conv_id, w.p + 1, w.n + CASE c WHEN 'I' THEN 0 ELSE 1 END, CASE c WHEN 'D' THEN w.last WHEN 'K' THEN r.initial ELSE forced[1] END,
    CASE c WHEN 'D' THEN told WHEN 'K' THEN list_append(told, r.role || ':' || r.text) WHEN 'R' THEN list_append(told, forced || ':' || r.text) ELSE list_append(told, forced || ':') END, w.audit
  FROM (SELECT *, substr(audit, p + 1, 1) AS c, CASE WHEN last = 'u' THEN 'assistant' ELSE 'user' END AS forced FROM walk WHERE p < length(audit)) w
  LEFT JOIN row_faults r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n + 1),
texts AS (SELECT conv_id, sha256(array_to_string(told, chr(10))) AS h FROM walk WHERE p = length(audit))
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, cost, audit, h AS repaired_sha256
FROM ids i LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN pairs p ON p.conv_id IS NOT DISTINCT FROM i.conv_id
JOIN audits u ON u.conv_id IS NOT DISTINCT FROM i.conv_id JOIN texts t ON t.conv_id IS NOT DISTINCT FROM i.conv_id
"""
