"""Conversation structure repair by rank-convergent parallel Viterbi.

A conversation is repaired by the cheapest edits of its turns (keep, rerole,
delete, insert an empty turn) after which its roles read ``(s?(ua)+)?``: nothing,
or an optional system turn and whole user/assistant exchanges.  The automaton has four
states, so a turn is a 4 x 4 matrix over (min, +) and a conversation a product of matrices.

Turns are sorted over the whole cluster by conversation and turn; a conversation
longer than a chunk, or one that crosses a task, is several chunks.  Backward
costs (cheapest way to the end, from every state) are run chunk by chunk: the
last chunk starts from the true costs, the others from speculative ones.
Fix-up passes give a chunk the costs its successor starts with and rerun it, from
its end, only until its costs differ from those of a former run by a constant; from
there on the two runs agree.  Turns such as an endless row of users never
converge, but only few vectors exist up to a constant, so a chunk remembers its runs and
the passes end after a few, whatever the number of chunks.  The runs are then stitched from the last
chunk to the first.  The audit is traced forward along the stitched backward costs,
in each step the ASCII-least edit that is still on a cheapest way; it is traced
speculatively from every entry state a chunk may have and stitched from the first chunk on.

Chunks hold one byte a turn while costs are run and traced; only the last step
touches texts again.  Conversations that are one whole chunk, nearly all, are
done in the first pass.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (always for a turn that is
blank or a duplicate), Insert 3; a truncated turn that is not deleted costs 3 more.
A role counts by its first letter.

Defined cases: a null role or text is one space, a role without letters has a
space for its initial; turns are ordered by turn (nulls first), then role,
then text; equal rows are repetitions of one turn and all but the first are
duplicates; rows without conversation form one conversation, whose id is null; a
conversation all of whose rows were dropped is repaired to nothing; very long
conversations and texts are cut into chunks of at most CHUNK_TURNS turns and about
CHUNK_BYTES; an empty table gives no rows; other columns are left out whatever
their names."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from judicata.llm.common import materialise

CHUNK_TURNS, CHUNK_BYTES = 4096, 4 << 20
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user or assistant turn that is put in.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Cheapest way to an accepted end without further turns.
END = (0, 2 * INSERT, INSERT, 0)
#: A turn's code: its initial and whether it is truncated; GONE must be deleted.
INITIALS, GONE = "sua?", 8
SUMMARY = "piece long, turns long, blank long, duplicate long, truncated long, illegal long, low long, high long, distinct long"
LEGAL = {"su", "ua", "au"}


def keeps(state: int, initial: int) -> int | None:
    """State after keeping a turn with this initial, if it may be kept."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return None if state == USER else USER
    return ASSISTANT if initial == 2 and state == USER else None


def _ways(state: int, code: int, after: tuple) -> list[tuple]:
    """(cost to the end, edit, state after) of all edits of one turn, costs after it given."""
    ways = [(DELETE + after[state], "D", state)]
    if code != GONE:
        more = TRUNCATED * (code >> 2)
        kept = keeps(state, code & 3)
        if kept is not None:
            ways.append((more + after[kept], "K", kept))
        ways.append((REROLE + more + after[NEXT[state]], "R", NEXT[state]))
    return ways


def _closed(costs: list[int]) -> tuple:
    """Costs with insertions before the turn: two at most lead anywhere."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


class Steps:
    """One turn back, up to a constant, and one turn on; both remembered."""

    def __init__(self):
        self.back: dict[tuple, tuple] = {}
        self.on: dict[tuple, tuple] = {}

    def before(self, after: tuple, code: int) -> tuple:
        got = self.back.get((after, code))
        if got is None:
            costs = _closed([min(w[0] for w in _ways(s, code, after)) for s in range(4)])
            least = min(costs)
            got = self.back[after, code] = tuple(c - least for c in costs)
        return got

    def trace(self, state: int, code: int, after: tuple) -> tuple[str, int]:
        """The least edits up to and with this turn, and the state after it."""
        got = self.on.get((state, code, after))
        if got is None:
            costs = _closed([min(w[0] for w in _ways(s, code, after)) for s in range(4)])
            edits, s = "", state
            while True:
                best = min((edit, to) for cost, edit, to in [*_ways(s, code, after), (INSERT + costs[NEXT[s]], "I", NEXT[s])]
                           if cost == costs[s])
                edits, s = edits + best[0], best[1]
                if best[0] != "I":
                    break
            got = self.on[state, code, after] = (edits, s)
        return got


def run_back(steps: Steps, codes: bytes, after: tuple, former: list[list[tuple]]) -> list[tuple]:
    """Costs before every turn and after the last.  Stops where a former run differs by a constant only."""
    least = min(after)
    costs = [tuple(c - least for c in after)]
    for i in range(len(codes) - 1, -1, -1):
        for run in former:
            if run[i + 1] == costs[-1]:
                return run[:i + 1] + costs[::-1]
        costs.append(steps.before(costs[-1], codes[i]))
    return costs[::-1]


def trace(steps: Steps, codes: bytes, costs: list[tuple], state: int) -> tuple[list[str], int]:
    """Edits by turn (insertions before it first) and the last state."""
    edits = []
    for i, code in enumerate(codes):
        e, state = steps.trace(state, code, costs[i + 1])
        edits.append(e)
    return edits, state


def trailing(state: int) -> str:
    """Insertions after the last turn."""
    return "I" * (END[state] // INSERT)


def spent(codes: bytes, edits: list[str]) -> int:
    cost = 0
    for code, e in zip(codes, edits):
        cost += INSERT * (len(e) - 1) + (DELETE if e[-1] == "D" else REROLE if e[-1] == "R" else 0)
        cost += TRUNCATED if e[-1] != "D" and code & 4 else 0
    return cost


def _repaired(roles: list[str], texts: list[str], edits: list[str], state: int) -> tuple[list[str], list[str], int]:
    """Roles and texts after the edits."""
    out_r, out_t = [], []

    def put(role: str | None, text: str) -> None:
        nonlocal state
        state = keeps(state, INITIALS.find(role[:1])) if role is not None else NEXT[state]
        out_r.append(role if role is not None else NAMES[state])
        out_t.append(text)

    for i, e in enumerate(edits):
        for edit in e:
            if edit == "I":
                put(None, "")
            elif edit == "K":
                put(roles[i], texts[i])
            elif edit == "R":
                put(None, texts[i])
    return out_r, out_t, state


def _turn_order(prefix: tuple[str, ...] = ()) -> list:
    return [F.col(c) for c in prefix] + [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def prepared(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, n, repeat): equal rows once, n how many; repeat: an earlier turn has the same role and text.

    ``rows`` are (conv, turn, role, text, n); n = 0 only keeps the conversation."""
    rows = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       F.col("n").cast("long").alias("n"))
    digest = [F.xxhash64("role", "text").alias("h1"), F.md5(F.concat_ws("\u0001", "role", "text")).alias("h2")]
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    seen = (rows.where("n > 0").select("conv", *digest, at.alias("at")).groupBy("conv", "h1", "h2")
            .agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first <> last"))
    once = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).select("*", *digest)
    seen = seen.select(F.col("conv").alias("c"), F.col("h1").alias("s1"), F.col("h2").alias("s2"), "first")
    joined = once.join(seen, once["conv"].eqNullSafe(seen["c"]) & (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")), "left")
    repeat = F.col("first").isNotNull() & (F.col("first") != at)
    return joined.select("conv", "turn", "role", "text", "n", F.coalesce(repeat, F.lit(False)).alias("repeat"))


PIECE = ("conv long, " + SUMMARY + ", first_initial string, last_initial string, whole boolean, cost long, codes binary, "
         "audit string, roles array<string>, texts array<string>")


class _Chunk:
    """A chunk being gathered: turns one by one, repetitions as deletions."""

    def __init__(self, conv, number: int, opens: bool):
        self.conv, self.number, self.opens = conv, number, opens
        self.codes, self.roles, self.texts = bytearray(), [], []
        self.counts = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "distinct"), 0)
        self.low = self.high = None
        self.first = self.last = None
        self.held = 0

    def turn(self, code: int, role: str, text: str) -> None:
        self.codes.append(code)
        self.roles.append(role if code != GONE else "")
        self.texts.append(text if code != GONE else "")
        self.held += len(text) if code != GONE else 0


def _row_codes(role: str, text: str, repeat: bool) -> tuple[str, int, str]:
    """Initial, code and fault of the first of equal rows."""
    initial = role[:1] or " "
    shown = text.rstrip("\t\n\x0b\x0c\r ")
    if not shown:
        return initial, GONE, "blank"
    if repeat:
        return initial, GONE, "duplicate"
    code = INITIALS.find(initial) if initial in "sua" else 3
    return (initial, code, "") if shown[-1] in ".!?" else (initial, code | 4, "truncated")


def pieces(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Sorted rows cut into chunks, one row each; chunks that are whole conversations are repaired."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the start of the text is enough to spread a conversation, and bounds what the sampling of the ranges holds
    spread = rows.repartitionByRange(n, F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64))
    ordered = spread.sortWithinPartitions(F.col("conv").asc_nulls_first(), *_turn_order())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, steps = TaskContext.get().partitionId() << 36, Steps()
        chunk, done, first_conv = None, [], True
        last_turn = last_initial = None

        def finish(c: _Chunk, closes: bool) -> None:
            whole = c.opens and closes
            audit, cost, roles, texts = None, None, c.roles, c.texts
            codes = bytes(c.codes)
            if whole:
                costs = run_back(steps, codes, END, [])
                edits, state = trace(steps, codes, costs, START)
                roles, texts, _ = _repaired(c.roles, c.texts, edits, START)
                tail = trailing(state)
                roles, texts = _with_tail(roles, texts, state)
                audit, cost = "".join(edits) + tail, spent(codes, edits) + INSERT * len(tail)
            done.append((c.conv, c.number, c.counts["turns"], c.counts["blank"], c.counts["duplicate"], c.counts["truncated"],
                         c.counts["illegal"], c.low, c.high, c.counts["distinct"], c.first, c.last, whole, cost, codes, audit, roles, texts))

        def batch() -> pa.RecordBatch:
            cols = list(zip(*done))
            done.clear()
            kinds = [pa.int64()] * 10 + [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.binary(), pa.string(),
                                         pa.list_(pa.string()), pa.list_(pa.string())]
            names = [f.split()[0] for f in PIECE.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for b in batches:
            for conv, turn, role, text, n_rows, repeat in zip(*(b.column(k).to_pylist() for k in range(6))):
                new = chunk is None or chunk.conv != conv
                if new and chunk is not None:
                    finish(chunk, True)
                    first_conv = False
                if new:
                    # the first conversation of a task may have begun in the one before
                    chunk = _Chunk(conv, number := number + 1, not first_conv)
                    last_turn = last_initial = None
                elif len(chunk.codes) >= CHUNK_TURNS or chunk.held >= CHUNK_BYTES:
                    finish(chunk, False)
                    chunk = _Chunk(conv, number := number + 1, False)
                if n_rows == 0:
                    continue
                initial, code, fault = _row_codes(role, text, repeat)
                k = chunk.counts
                k["turns"] += n_rows
                if fault == "blank":
                    k["blank"] += n_rows
                else:
                    k["duplicate"] += n_rows if fault == "duplicate" else n_rows - 1
                    k["truncated"] += fault == "truncated"
                k["illegal"] += (n_rows - 1) + (last_initial is not None and chunk.first is not None and last_initial + initial not in LEGAL)
                if turn is not None:
                    # a turn that goes on from the chunk before counts again here and is taken off where chunks meet
                    k["distinct"] += turn != last_turn or chunk.low is None
                    chunk.low = turn if chunk.low is None else chunk.low
                    chunk.high = turn
                chunk.first = initial if chunk.first is None else chunk.first
                chunk.last = initial
                last_turn, last_initial = turn, initial
                chunk.turn(code, role, text)
                rest = n_rows - 1
                while rest:
                    room = max(1, CHUNK_TURNS - len(chunk.codes))
                    take = min(rest, room)
                    chunk.codes.extend(bytes([GONE]) * take)
                    chunk.roles.extend([""] * take)
                    chunk.texts.extend([""] * take)
                    rest -= take
                    if rest and len(chunk.codes) >= CHUNK_TURNS:
                        low = chunk.high
                        finish(chunk, False)
                        chunk = _Chunk(conv, number := number + 1, False)
                        chunk.first = chunk.last = initial
                        chunk.counts["illegal"] = -1 if initial + initial not in LEGAL else 0       # met again where chunks meet
                        if turn is not None:
                            chunk.low = chunk.high = low
                            chunk.counts["distinct"] = 1
                        if len(done) >= 64:
                            yield batch()
                if len(done) >= 256:
                    yield batch()
            if done:
                yield batch()
        if chunk is not None:
            finish(chunk, False)            # it may go on in the next task
        if done:
            yield batch()

    return ordered.mapInArrow(run, PIECE)


def _with_tail(roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    for _ in trailing(state):
        state = NEXT[state]
        roles, texts = [*roles, NAMES[state]], [*texts, ""]
    return roles, texts


def _linked(open_pieces: DataFrame) -> DataFrame:
    """Chunks of one conversation, numbered from the first on."""
    w = Window.partitionBy("conv").orderBy("piece")
    return (open_pieces.withColumn("seq", F.row_number().over(w)).withColumn("is_last", F.lead("piece").over(w).isNull()))


RUN = "conv long, seq int, after array<long>, costs binary, before array<long>"


def _rerun(chunks: DataFrame, asked: DataFrame, known: DataFrame | None) -> DataFrame:
    """Runs of chunks from costs after them that they have not run from yet."""
    def run(key, chunk: pa.Table, runs: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if chunk.num_rows:
            steps, codes = Steps(), chunk.column("codes")[0].as_py()
            r = runs.to_pylist()
            former = {tuple(x["after"]): _unpacked(x["costs"]) for x in r if x["costs"] is not None}
            for after in sorted({tuple(x["after"]) for x in r if x["costs"] is None} - set(former)):
                costs = former[after] = run_back(steps, codes, after, list(former.values()))
                out.append((chunk.column("conv")[0].as_py(), chunk.column("seq")[0].as_py(), list(after), _packed(costs), list(costs[0])))
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())))],
                        names=["conv", "seq", "after", "costs", "before"])

    asked = asked.select("conv", "seq", "after", F.lit(None).cast("binary").alias("costs"))
    both = asked if known is None else asked.unionByName(known.select("conv", "seq", "after", "costs"))
    return (chunks.select("conv", "seq", "codes").groupBy("conv", "seq").cogroup(both.groupBy("conv", "seq")).applyInArrow(run, RUN))


def _packed(costs: list[tuple]) -> bytes:
    return bytes(v for c in costs for v in c)          # at most DELETE + 2 * INSERT apart


def _unpacked(blob: bytes) -> list[tuple]:
    return [tuple(blob[i:i + 4]) for i in range(0, len(blob), 4)]


def _stitch(chunks: DataFrame, runs: DataFrame) -> DataFrame:
    """(conv, seq, after, state): the true costs after every chunk and the state it is entered with.

    One row per chunk and run is sorted by chunk and streamed, first back, then on."""
    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, true, seq = (), None, None
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                if (r["conv"],) != at:
                    at, true, seq, before = (r["conv"],), END, None, None
                if r["seq"] != seq:
                    true = before if seq is not None else END
                    seq = r["seq"]
                if tuple(r["after"]) == tuple(true):
                    before = tuple(r["before"])
                    out.append((r["conv"], r["seq"], list(true)))
            cols = list(zip(*out)) or [()] * 3
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.list_(pa.int64())))],
                                  names=["conv", "seq", "after"])

    true = (runs.select("conv", "seq", "after", "before").repartition("conv")
            .sortWithinPartitions(F.col("conv"), F.col("seq").desc()).mapInArrow(back, "conv long, seq int, after array<long>"))
    true = materialise(true)

    def ways(key, chunk: pa.Table, run: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if chunk.num_rows and run.num_rows:
            steps, codes, costs = Steps(), chunk.column("codes")[0].as_py(), _unpacked(run.column("costs")[0].as_py())
            ends: list[int] = [trace(steps, codes, costs, s)[1] for s in range(4)]
            out.append((chunk.column("conv")[0].as_py(), chunk.column("seq")[0].as_py(), ends, run.column("costs")[0].as_py()))
        cols = list(zip(*out)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary()))],
                        names=["conv", "seq", "ends", "costs"])

    picked = runs.join(true.select(F.col("conv").alias("c"), F.col("seq").alias("s"), F.col("after").alias("a")),
                       F.col("conv").eqNullSafe(F.col("c")) & (F.col("seq") == F.col("s")) & (F.col("after") == F.col("a")), "left_semi")
    traced = materialise(chunks.select("conv", "seq", "codes").groupBy("conv", "seq")
                         .cogroup(picked.select("conv", "seq", "costs").groupBy("conv", "seq"))
                         .applyInArrow(ways, "conv long, seq int, ends array<int>, costs binary"))

    def on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = (), START
        for b in batches:
            out: list[tuple] = []
            for conv, seq, ends in zip(*(b.column(k).to_pylist() for k in range(3))):
                if (conv,) != at:
                    at, state = (conv,), START
                out.append((conv, seq, state))
                state = ends[state]
            cols = list(zip(*out)) or [()] * 3
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())],
                                  names=["conv", "seq", "state"])

    entered = (traced.select("conv", "seq", "ends").repartition("conv").sortWithinPartitions("conv", "seq")
               .mapInArrow(on, "conv long, seq int, state int"))
    e = entered.select(F.col("conv").alias("c"), F.col("seq").alias("s"), "state")
    return traced.join(e, F.col("conv").eqNullSafe(F.col("c")) & (F.col("seq") == F.col("s"))).select("conv", "seq", "costs", "state")


def _edited(chunks: DataFrame, stitched: DataFrame) -> DataFrame:
    """Audit, cost, repaired roles and texts of every chunk, from its true costs and entry state."""
    s = stitched.select(F.col("conv").alias("c"), F.col("seq").alias("s"), F.col("costs").alias("true"), "state")
    rows = chunks.join(s, F.col("conv").eqNullSafe(F.col("c")) & (F.col("seq") == F.col("s")))
    keep = [f.split()[0] for f in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for b in batches:
            cost, audit, roles, texts = [], [], [], []
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                edits, state = trace(steps, r["codes"], _unpacked(r["true"]), r["state"])
                out_r, out_t, state = _repaired(r["roles"], r["texts"], edits, r["state"])
                tail = trailing(state) if r["is_last"] else ""
                if tail:
                    out_r, out_t = _with_tail(out_r, out_t, state)
                cost.append(spent(r["codes"], edits) + INSERT * len(tail))
                audit.append("".join(edits) + tail)
                roles.append(out_r)
                texts.append(out_t)
            new = {"cost": pa.array(cost, pa.int64()), "audit": pa.array(audit, pa.string()),
                   "roles": pa.array(roles, pa.list_(pa.string())), "texts": pa.array(texts, pa.list_(pa.string()))}
            yield pa.record_batch([new[c] if c in new else b.column(c) for c in keep], names=keep)

    return rows.select(*keep, "is_last", "true", "state").mapInArrow(run, PIECE)


def repair(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Repaired chunks: ``rows`` are (conv, turn, role, text, n), n how often the row stands there.

    One row per chunk, in order of ``piece`` within a conversation: counts, edits
    (``audit``), their cost, and the repaired roles and texts.  See
    :func:`repaired_turns` and :func:`summary`."""
    cut = materialise(pieces(prepared(rows), partitions))
    # two chunks at most a task, and those of long conversations: a conversation that is one of them is not yet known to be whole
    chunks = materialise(_linked(cut.where("NOT whole")))
    wanted = chunks.select("conv", "seq", F.array(*[F.lit(v).cast("long") for v in END]).alias("after"))
    known = None
    while not wanted.isEmpty():
        found = materialise(_rerun(chunks, wanted, known))
        known = found if known is None else known.unionByName(found)
        wanted = found.where("seq > 1").select("conv", (F.col("seq") - 1).alias("seq"), F.col("before").alias("after"))
    if known is None:
        return cut
    return cut.where("whole").unionByName(materialise(_edited(chunks, _stitch(chunks, known))))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """(conv, piece, place, role, text): the turns of the repaired conversations."""
    return (repaired.select("conv", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "t"))
            .select("conv", "piece", "place", F.col("t.roles").alias("role"), F.col("t.texts").alias("text")))


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the digest of its repaired text.

    A digest and an audit are one value a conversation, so the chunks of a long
    one are streamed in order through one task, a row a chunk."""
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    rows = repaired.select("conv", "piece", "turns", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct",
                           "first_initial", "last_initial", "whole", "cost", "audit", F.array_join(lines, "\n").alias("said"),
                           F.size("roles").alias("n_said"))
    gaps = F.expr("coalesce(try_cast(cast(high AS decimal(38,0)) - low + 1 - distinct AS bigint), 0)")
    out = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    done = rows.where("whole").withColumn("gaps", gaps).withColumn("repaired_sha256", F.sha2(F.col("said").cast("binary"), 256)).select(*out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = (), None

        def result(h: dict) -> pa.RecordBatch:
            gaps = 0 if h["low"] is None else h["high"] - h["low"] + 1 - h["distinct"]
            values = [h["conv"], gaps if abs(gaps) < 2 ** 63 else 0, h["blank"], h["duplicate"], h["truncated"], h["illegal"], h["cost"],
                      "".join(h["audit"]), h["sha"].hexdigest()]
            return pa.record_batch([pa.array([v], pa.string() if isinstance(v, str) else pa.int64()) for v in values], names=out)

        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                if (r["conv"],) != at:
                    if held is not None:
                        yield result(held)
                    at = (r["conv"],)
                    held = {"conv": r["conv"], "low": None, "high": None, "distinct": 0, "blank": 0, "duplicate": 0, "truncated": 0,
                            "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False, "last": None}
                h = held
                for c in ("distinct", "blank", "duplicate", "truncated", "illegal", "cost"):
                    h[c] += r[c]
                if r["low"] is not None:
                    h["distinct"] -= h["high"] == r["low"]
                    h["low"] = r["low"] if h["low"] is None else h["low"]
                    h["high"] = r["high"]
                if r["first_initial"] is not None:
                    h["illegal"] += h["last"] is not None and h["last"] + r["first_initial"] not in LEGAL
                    h["last"] = r["last_initial"]
                h["audit"].append(r["audit"])
                if r["n_said"]:
                    h["sha"].update((("\n" if h["any"] else "") + r["said"]).encode())
                    h["any"] = True
        if held is not None:
            yield result(held)

    kinds = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    long = rows.where("NOT whole").repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(run, kinds)
    return done.unionByName(long)
