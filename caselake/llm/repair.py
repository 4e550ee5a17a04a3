"""Conversation structure repair: turns aligned with strings of the alternating grammar.

A repaired conversation's role initials read ``(s?(ua)+)?``. Edits are Keep (0),
Rerole to user or assistant (2), Delete (3, required for blank and duplicate
turns) and Insert of an empty user or assistant turn (2); a truncated turn that
stays adds 1. Of the cheapest edit lists the ASCII-least string of initials wins.

1. Turns are dealt over the cluster by ranges of conversation and turn, so a
   conversation of any length is spread over many tasks.
2. Each run of ``BLOCK`` turns is aligned (Wagner-Fischer) with every feasible
   length of the grammar between each two phases: start, after s, after u, after
   a. The incumbent's cost bounds both the lengths tried and the cells computed
   (Ukkonen bands); the first band is doubled until a path fits. Alignments of
   equal cost compare their backtraced audits.
3. Tables of neighbouring runs are joined phase by phase. That is exact: of two
   audits over the same turns neither begins the other unless it costs less, so
   the least of joined audits is the join of least ones.
4. Turns are read once more in order beside their audit, one at a time, which
   gives the repaired turns.

Only step 4 and the join of a conversation's tables see a conversation as a whole:
they hold its audit (a letter a turn), never its texts.

Defined results: null roles and texts count as one space; a role whose initial
is not s, u or a is kept nowhere. Turns are ordered by turn (nulls first), turns
that share one by role and digest of the text. A turn's first fault of blank,
duplicate, truncated counts. A conversation without turns has zeros, an empty
audit and no repaired turns. A null id is a conversation of its own.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import SPACES, dict_rows, record_batches, stored, table
from caselake.operators.joins import join_summary

#: Turns aligned together; longer conversations are joined from such blocks.
BLOCK = 32
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
START, AFTER_S, AFTER_U, AFTER_A = range(4)
PHASES = range(4)
ACCEPTED = (START, AFTER_A)
ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
Table = dict[tuple[int, int], tuple[int, str]]


# --- alignment -------------------------------------------------------------------------------------

def _alternating(first: str, length: int) -> str:
    return ("ua" if first == "u" else "au") * (length // 2) + (first if length % 2 else "")


def targets(entry: int, leave: int, length: int) -> list[str]:
    """The grammar's strings of ``length`` that lead from phase ``entry`` to phase ``leave``."""
    found = [_alternating("a" if entry == AFTER_U else "u", length)]
    if entry == START and length:
        found.append("s" + _alternating("u", length - 1))
    return [t for t in found if ("sua".index(t[-1]) + 1 if t else entry) == leave]


def _match(symbol: str, wanted: str) -> tuple[str, int] | None:
    """Letter and cost of keeping or reroling a turn as ``wanted``."""
    if symbol == "-":
        return None
    late = TRUNCATED if symbol.isupper() else 0
    if symbol.lower() == wanted:
        return "K", late
    return ("R", REROLE + late) if wanted != "s" else None


def align(symbols: str, target: str, bound: int) -> tuple[int, str] | None:
    """Least cost and ASCII-least audit of aligning turns with ``target``; None if it costs more than ``bound``.

    A symbol is the initial of a turn's role (x for any other), in upper case if
    it is truncated, or - if it must go. Cells whose distance from the diagonal of
    free turns costs more than the bound leaves are never computed.
    """
    n, m = len(symbols), len(target)
    free = [0]
    for symbol in symbols:
        free.append(free[-1] + (symbol != "-"))
    spare = bound - DELETE * (n - free[n])
    if spare < 0:
        return None
    reach = spare // INSERT
    rest: list[dict[int, int]] = [{} for _ in range(n + 1)]  # cost from a cell to the end
    for i in range(n, -1, -1):
        row, below = rest[i], rest[i + 1] if i < n else {}
        for j in range(min(m, free[i] + reach), max(0, free[i] - reach) - 1, -1):
            costs = [0] if i == n and j == m else []
            if j in below:
                costs.append(DELETE + below[j])
            if j < m:
                if target[j] != "s" and j + 1 in row:
                    costs.append(INSERT + row[j + 1])
                if i < n and j + 1 in below and (move := _match(symbols[i], target[j])):
                    costs.append(move[1] + below[j + 1])
            if costs:
                row[j] = min(costs)
    cost = rest[0].get(0)
    if cost is None or cost > bound:
        return None
    letters, i, j = [], 0, 0
    while i < n or j < m:  # letters in ASCII order: the first that leads on at the least cost
        left = rest[i][j]
        move = _match(symbols[i], target[j]) if i < n and j < m else None
        if i < n and rest[i + 1].get(j, left) + DELETE == left:
            letters.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest[i].get(j + 1, left) + INSERT == left:
            letters.append("I")
            j += 1
        else:
            letters.append(move[0])
            i, j = i + 1, j + 1
    return cost, "".join(letters)


def cheapest(symbols: str, entry: int, leave: int) -> tuple[int, str] | None:
    """Best alignment over all lengths of the grammar between two phases, nearest lengths first."""
    free = sum(s != "-" for s in symbols)
    base = DELETE * (len(symbols) - free)
    system = any(s in "sS" for s in symbols)
    best, off = None, 0
    while best is None or base + INSERT * off <= best[0]:
        for length in {free + off, free - off}:
            for target in targets(entry, leave, length) if length >= 0 else ():
                if target.startswith("s") and not system:
                    continue
                if best is None:  # no incumbent: widen the band until a path fits
                    most = DELETE * len(symbols) + INSERT * length + TRUNCATED
                    bound, found = base + INSERT * off + 2, None
                    while not (found := align(symbols, target, bound)) and bound < most:
                        bound = min(2 * bound + 2, most)
                else:
                    found = align(symbols, target, best[0])
                if found and (best is None or found < best):
                    best = found
        off += 1
        if off > free + 2 and best is None:
            return None
    return best


def block_table(symbols: str, entries: tuple[int, ...], leaves: tuple[int, ...]) -> Table:
    found = {(p, q): cheapest(symbols, p, q) for p in entries for q in leaves}
    return {pq: best for pq, best in found.items() if best is not None}


def join_tables(left: Table, right: Table) -> Table:
    out: Table = {}
    for (p, q), (cost, audit) in left.items():
        for r in PHASES:
            if (q, r) in right:
                more, rest = right[q, r]
                if (p, r) not in out or (cost + more, audit + rest) < out[p, r]:
                    out[p, r] = cost + more, audit + rest
    return out


def table_of(symbols: Iterable[str], starts: bool, ends: bool, aligned: Callable[..., Table] = block_table) -> Table:
    """Table of a run of turns; neighbours of equal size are joined first, so letters are copied log n times.

    ``starts`` and ``ends`` tell that the run is known to begin or end its
    conversation; ``aligned`` gives the table of a block.
    """
    text = "".join(symbols)
    stack: list[tuple[int, Table]] = []
    blocks = [text[i:i + BLOCK] for i in range(0, len(text), BLOCK)] or [""]
    for k, block in enumerate(blocks):
        entries = (START,) if starts and k == 0 else tuple(PHASES)
        leaves = ACCEPTED if ends and k == len(blocks) - 1 else tuple(PHASES)
        size, found = 1, aligned(block, entries, leaves)
        while stack and stack[-1][0] == size:
            size, found = 2 * size, join_tables(stack.pop()[1], found)
        stack.append((size, found))
    found = stack.pop()[1]
    while stack:
        found = join_tables(stack.pop()[1], found)
    return found


# --- turns of the cluster --------------------------------------------------------------------------

ORDER = ("conv_id", "turn", "role", "key")
RUNS = ("conv_id long, turn long, role string, key string, n long, blank long, duplicate long, truncated long, illegal long, "
        "turns long, least long, most long, first string, last string, costs array<long>, audits array<string>")
AUDITS = ("conv_id long, n_turns long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string")
TURNS = "conv_id long, position long, edit string, role string, text string"
_LONG, _TEXT = pa.int64(), pa.string()
_RUN_SCHEMA = pa.schema([
    ("conv_id", _LONG), ("turn", _LONG), ("role", _TEXT), ("key", _TEXT), ("n", _LONG), ("blank", _LONG), ("duplicate", _LONG),
    ("truncated", _LONG), ("illegal", _LONG), ("turns", _LONG), ("least", _LONG), ("most", _LONG), ("first", _TEXT),
    ("last", _TEXT), ("costs", pa.list_(_LONG)), ("audits", pa.list_(_TEXT))])
_AUDIT_SCHEMA = pa.schema([(c, _TEXT if c == "audit" else _LONG) for c in
                           "conv_id n_turns gaps blank duplicate truncated illegal cost audit".split()])
_TURN_SCHEMA = pa.schema([("conv_id", _LONG), ("position", _LONG), ("edit", _TEXT), ("role", _TEXT), ("text", _TEXT)])
_DIGEST_SCHEMA = pa.schema([("conv_id", _LONG), ("sha256", _TEXT)])


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" "))


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and key (digest of conversation, role and text)."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                _or_space("role").alias("role"), _or_space("text").alias("text"))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    return rows.withColumn("key", F.sha2(F.concat_ws(":", conv, F.length("role").cast("string"), "role", "text"), 256))


def _judged(turns: DataFrame) -> DataFrame:
    """Turns without their texts: code (initial), blank, truncated, and repeated (role and text at an earlier turn)."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.left("role", F.lit(1))
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    narrow = turns.select(*ORDER, code.alias("code"), (bare == "").alias("blank"),
                          (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    when = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    earliest = narrow.groupBy("key").agg(F.min(when).alias("earliest"))
    return join_summary(narrow, earliest, "key").withColumn("repeated", when > F.col("earliest")).drop("earliest")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation's stretch of a partition: its counts and its table of alignments."""
    remembered = functools.lru_cache(maxsize=1 << 15)(block_table)  # short conversations look alike

    def close(run: dict, symbols: list[str], starts: bool, ends: bool) -> tuple:
        found = table_of(symbols, starts, ends, remembered)
        cells = [found.get((p, q)) for p in PHASES for q in PHASES]
        return (*(run[f.name] for f in list(_RUN_SCHEMA)[:-2]), [c and c[0] for c in cells], [c and c[1] for c in cells])

    def rows() -> Iterator[tuple]:
        run: dict | None = None
        symbols: list[str] = []
        before: tuple = ()
        first = True  # the partition's first conversation may have begun in another one
        for r in dict_rows(batches):
            if run is None or r["conv_id"] != run["conv_id"]:
                if run is not None:
                    yield close(run, symbols, not first, True)
                    first = False
                run = dict.fromkeys(_RUN_SCHEMA.names, 0) | {c: r[c] for c in ORDER} | {"least": None, "most": None, "first": r["code"]}
                symbols, before = [], ()
            now = (r["turn"], r["role"], r["key"])
            fault = "blank" if r["blank"] else "duplicate" if r["repeated"] or now == before else "truncated" if r["truncated"] else None
            if fault:
                run[fault] += 1
            if before and run["last"] + r["code"] not in _LEGAL:
                run["illegal"] += 1
            if r["turn"] is not None and r["turn"] != run["most"]:
                run["least"] = r["turn"] if run["least"] is None else run["least"]
                run["most"] = r["turn"]
                run["turns"] += 1
            run["n"] += 1
            run["last"] = r["code"]
            symbols.append("-" if fault in ("blank", "duplicate") else r["code"].upper() if fault else r["code"])
            before = now
        if run is not None:
            yield close(run, symbols, not first, False)

    return record_batches(rows(), _RUN_SCHEMA)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each conversation, in order, joined to one audit."""
    def unpacked(r: dict) -> Table:
        return {(i // 4, i % 4): (c, a) for i, (c, a) in enumerate(zip(r["costs"], r["audits"])) if c is not None}

    def close(runs: list[dict]) -> tuple:
        runs = [r for r in runs if r["n"]]
        total = {c: sum(r[c] for r in runs) for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
        dated = [r for r in runs if r["most"] is not None]
        for one, two in zip(runs, runs[1:]):
            total["illegal"] += one["last"] + two["first"] not in _LEGAL
        for one, two in zip(dated, dated[1:]):
            total["turns"] -= one["most"] == two["least"]
        gaps = dated[-1]["most"] - dated[0]["least"] + 1 - total["turns"] if dated else 0
        tables = [unpacked(r) for r in runs] or [{(START, START): (0, "")}]
        while len(tables) > 1:  # neighbours first, so letters are copied log n times
            tables = [join_tables(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
        cost, audit = min(tables[0][START, q] for q in ACCEPTED if (START, q) in tables[0])
        return total["n"], gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost, audit

    def rows() -> Iterator[tuple]:
        runs: list[dict] = []
        for r in dict_rows(batches):
            if runs and r["conv_id"] != runs[0]["conv_id"]:
                yield runs[0]["conv_id"], *close(runs)
                runs = []
            runs.append(r)
        if runs:
            yield runs[0]["conv_id"], *close(runs)

    return record_batches(rows(), _AUDIT_SCHEMA)


def audits(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: n_turns, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``ids`` (conv_id) adds conversations that may have no turns.
    """
    spread = _judged(_turns(conversations)).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    runs = spread.mapInArrow(_runs, RUNS)
    if ids is not None:
        named = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        runs = runs.unionByName(named.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    return runs.repartition("conv_id").sortWithinPartitions(*ORDER).mapInArrow(_joined, AUDITS)


def repaired_turns(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """The turns that the audits of ``found`` leave: conv_id, position, edit, role, text.

    Rows of a conversation stay together and in order; deleted turns are gone.
    """
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            audit, at, position, expected = "", 0, 0, "u"

            def inserted() -> Iterator[tuple]:
                nonlocal at, position, expected
                while at < len(audit) and audit[at] == "I":
                    yield conv, position, "I", ROLES[expected], ""
                    at, position, expected = at + 1, position + 1, "a" if expected == "u" else "u"

            for r in dict_rows(batches):
                conv = r["conv_id"]
                if r["audit"] is not None:
                    audit, at, position, expected = r["audit"], 0, 0, "u"
                else:
                    edit = audit[at]
                    if edit != "D":
                        role = r["role"] if edit == "K" else ROLES[expected]
                        yield conv, position, edit, role, r["text"]
                        position, expected = position + 1, "a" if role[0] == "u" else "u"
                    at += 1
                yield from inserted()

        return record_batches(rows(), _TURN_SCHEMA)

    turns = _turns(conversations).withColumn("audit", F.lit(None).cast("string"))
    lines = turns.unionByName(found.select("conv_id", "audit"), allowMissingColumns=True)
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *ORDER[1:])
    return ordered.drop("turn", "key").mapInArrow(repair, TURNS)


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and sha256 of the ``role:text`` lines, for turns as :func:`repaired_turns` orders them."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv = digest = None
            for r in dict_rows(batches):
                if digest is None or r["conv_id"] != conv:
                    if digest is not None:
                        yield conv, digest.hexdigest()
                    conv, digest = r["conv_id"], hashlib.sha256()
                    digest.update(f"{r['role']}:{r['text']}".encode())
                else:
                    digest.update(f"\n{r['role']}:{r['text']}".encode())
            if digest is not None:
                yield conv, digest.hexdigest()

        return record_batches(rows(), _DIGEST_SCHEMA)

    return turns.mapInArrow(read, "conv_id long, sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut short, repeated or given another role, as a checksum of id and turn decides."""
    rows = conversations.select("conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"))
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
                       F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("_way", F.crc32(name) % 20).filter("_way != 0")
    text = F.when(F.col("_way") == 1, "").when(F.col("_way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("_way") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("_way") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("_copy")).drop("_copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    turns = damaged(conversations)
    found = stored(audits(turns, conversations.select("conv_id")), "audits")
    lines = digests(repaired_turns(turns, found)).withColumnRenamed("conv_id", "_conv")
    return found.join(lines, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _sql() -> str:
    """The same by a shortest path over four phases, a conversation's cost and audit joined in one sortable text."""
    def plus(state: str, cost: str, letters: str) -> str:
        return f"(printf('%09d', CAST(left({state}, 9) AS INTEGER) + {cost}) || substr({state}, 10) || '{letters}')"

    def least(options: list[str]) -> str:
        return f"least({', '.join(options)})"  # nulls are left out

    after = {0: [], 1: [], 2: [], 3: []}
    for p in PHASES:
        wanted = 3 if p == 2 else 2  # phase after the next u or a
        for insert, q in (("", p), ("I", wanted)):
            cost = 2 if insert else 0
            after[q].append(plus(f"s{p}", f"{cost + 3}", insert + "D"))
            nxt = 3 if q == 2 else 2
            letter = "a" if nxt == 3 else "u"
            after[nxt].append(f"CASE WHEN o AND c = '{letter}' THEN {plus(f's{p}', f'{cost} + t', insert + 'K')} END")
            after[nxt].append(f"CASE WHEN o AND c != '{letter}' THEN {plus(f's{p}', f'{cost} + 2 + t', insert + 'R')} END")
            if q == 0:
                after[1].append(f"CASE WHEN o AND c = 's' THEN {plus(f's{p}', f'{cost} + t', insert + 'K')} END")
    steps = ", ".join(f"{least(after[q])} AS s{q}" for q in PHASES)
    final = least(["s0", "s3", plus("s2", "2", "I"), plus("s0", "4", "II"), plus("s1", "4", "II")])
    return rf"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([x::BIGINT] || range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY x) AS t
  FROM generate_series(0, 255) AS g(x)),
w AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce([4294967295::BIGINT] ||
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT),
    lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))) % 20 AS way FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
    CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(generate_series(1, CASE way WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM w WHERE way != 0),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS c FROM d),
g AS (SELECT *, NOT blank AND NOT seen AS o, CASE WHEN cut THEN 1 ELSE 0 END AS t, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM f),
ids AS (SELECT DISTINCT conv_id FROM conversations),
r AS (SELECT conv_id, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM ids
  UNION ALL SELECT conv_id, i, s0, s1, s2, s3 FROM (SELECT r.conv_id, r.i + 1 AS i, {steps}
    FROM r JOIN g ON g.conv_id IS NOT DISTINCT FROM r.conv_id AND g.i = r.i + 1)),
e AS (SELECT conv_id, {final} AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS k FROM r) WHERE k = 1),
l AS (SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit FROM e),
letters AS (SELECT conv_id, k, substr(audit, k::INTEGER, 1) AS edit FROM (SELECT conv_id, audit, unnest(generate_series(1, length(audit))) AS k FROM l)),
placed AS (SELECT *, count(*) FILTER (edit != 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
  count(*) FILTER (edit != 'D') OVER (PARTITION BY conv_id ORDER BY k) - 1 AS n FROM letters),
lines AS (SELECT a.conv_id, a.k, a.n, a.edit, g.role, CASE edit WHEN 'I' THEN '' ELSE g.text END AS text,
    first_value(CASE WHEN a.edit = 'K' AND g.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY a.conv_id ORDER BY a.k) AS s
  FROM placed a LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM a.conv_id AND g.i = a.i AND a.edit != 'I' WHERE a.edit != 'D'),
texts AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (n - s) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text,
  chr(10) ORDER BY k)) AS h FROM lines GROUP BY 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (NOT blank AND seen) AS duplicate, count(*) FILTER (NOT blank AND NOT seen AND cut) AS truncated,
  count(*) FILTER (p IS NOT NULL AND p || c NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY 1)
SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, cost, audit, coalesce(h, sha256('')) AS repaired_sha256
FROM l LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM l.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM l.conv_id"""


OP11_SQL = _sql()
