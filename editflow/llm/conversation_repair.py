"""Repair of conversation structure by weighted interval parsing (CYK).

The role initials of a repaired conversation follow ``(s?(ua)+)?``. The grammar in Chomsky normal
form has one nonterminal for each pair of places in that pattern: ``[p q] -> [p r] [r q]``, a row
gives terminals (keep, change the role, delete), and insertions are closed over beforehand, so that a
cell (span, nonterminal) holds its least ``(cost, audit)``. Cells are combined bottom-up by span length.

Products of closed cells are associative: every split of a span gives the same cell. So one split for
each span is combined and spans double in length, over the rows of a segment inside a task, then over a
conversation's segments in shuffled rounds. No conversation has to fit in a task; only its audit, which
is a single value of the result, does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editflow.llm.common import ASCII_SPACE, own_columns, saved

SEGMENT_BITS = 9  # rows of a segment, as a power of two: what one chart is built over
FAN = 64  # segments of a conversation that one round combines

# Costs of the edits and what an undeleted truncated row adds.
RE_ROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
OK, BLANK, DUPLICATE, CUT = range(4)

# Places of the pattern: before anything, after s, after u, after a. It may end at START and at AFTER_A.
START, AFTER_S, AFTER_U, AFTER_A = PLACES = range(4)
MOVES = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A,
         (AFTER_A, "u"): AFTER_U}
ENDS = (START, AFTER_A)
ROLES = {"u": "user", "a": "assistant"}

Cells = dict[tuple[int, int], tuple[int, str]]  # nonterminal -> least (cost, audit) over a span


def _least(cells: Cells, key: tuple[int, int], value: tuple[int, str]) -> None:
    if key not in cells or value < cells[key]:
        cells[key] = value


def combine(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts, by the rules ``[p q] -> [p r] [r q]``."""
    out: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in PLACES:
            part = right.get((r, q))
            if part:
                _least(out, (p, q), (cost + part[0], audit + part[1]))
    return out


def _closure() -> Cells:
    """Insertions alone: the least ways from place to place over no row."""
    cells: Cells = {(p, p): (0, "") for p in PLACES}
    for (p, initial), q in MOVES.items():
        if initial in ROLES:
            _least(cells, (p, q), (INSERT, "I"))
    while (wider := combine(cells, cells)) != cells:
        cells = wider
    return cells


CLOSURE = _closure()


def leaf(initial: str, fault: int) -> Cells:
    """Cells of one row, closed under insertions on both sides."""
    cells: Cells = {(p, p): (DELETE, "D") for p in PLACES}
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT else 0
        for (p, x), q in MOVES.items():
            if x == initial:
                _least(cells, (p, q), (more, "K"))
            if x in ROLES:
                _least(cells, (p, q), (RE_ROLE + more, "R"))
    return combine(combine(CLOSURE, cells), CLOSURE)


def chart(cells: list[Cells]) -> Cells:
    """Bottom-up by span length: neighbours are combined until one cell spans everything."""
    while len(cells) > 1:
        cells = [combine(*cells[k:k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0] if cells else CLOSURE


def best(cells: Cells) -> tuple[int, str]:
    """The cheapest whole parse, ties to the least audit."""
    return min(cells[START, q] for q in ENDS if (START, q) in cells)


# ------------------------------------------------------------------------------ rows of a segment

_RUN = ("seg long, n long, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, "
        "first_turn long, last_turn long, first_initial string, last_initial string, costs array<long>, audits array<string>")
_NAMES = [c.split()[0] for c in _RUN.split(", ")]
LEGAL = ("su", "ua", "au")


def _packed(cells: Cells) -> tuple[list, list]:
    got = [cells.get((p, q), (None, None)) for p in PLACES for q in PLACES]
    return [c for c, _ in got], [a for _, a in got]


def _unpacked(costs: list, audits: list) -> Cells:
    return {(k // 4, k % 4): (c, a) for k, (c, a) in enumerate(zip(costs, audits, strict=True)) if c is not None}


def _join_runs(runs: list[dict]) -> dict:
    """One run from neighbouring ones of a conversation, in order."""
    out = dict(runs[0])
    for right in runs[1:]:
        for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns"):
            out[c] += right[c]
        out["illegal"] += out["last_initial"] + right["first_initial"] not in LEGAL
        if out["last_turn"] is not None and out["last_turn"] == right["first_turn"]:
            out["turns"] -= 1
        for c, pick in (("low", min), ("high", max)):
            known = [x for x in (out[c], right[c]) if x is not None]
            out[c] = pick(known) if known else None
        out["last_initial"] = right["last_initial"]
        # Null turns come first, so a run without a turn has none before it either.
        out["first_turn"] = out["first_turn"] if out["first_turn"] is not None else right["first_turn"]
        out["last_turn"] = right["last_turn"] if right["last_turn"] is not None else out["last_turn"]
    out["costs"], out["audits"] = _packed(chart([_unpacked(r["costs"], r["audits"]) for r in runs]))
    return out


def _row_run(seg: int, turn: int | None, initial: str, fault: int, leaves: dict) -> dict:
    if (initial, fault) not in leaves:
        leaves[initial, fault] = _packed(leaf(initial, fault))
    costs, audits = leaves[initial, fault]
    return {"seg": seg, "n": 1, "blank": int(fault == BLANK), "duplicate": int(fault == DUPLICATE),
            "truncated": int(fault == CUT), "illegal": 0, "low": turn, "high": turn, "turns": int(turn is not None),
            "first_turn": turn, "last_turn": turn, "first_initial": initial, "last_initial": initial,
            "costs": costs, "audits": audits}


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Neighbouring rows with equal keys, across batches."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[k] != held[0][k] for k in keys):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _emit(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield _emit(out, schema)
            out = []
    if out:
        yield _emit(out, schema)


def _arrow(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def _runs(schema: pa.Schema):
    def run(batches):
        leaves: dict = {}

        def rows():
            for group in _grouped(batches, ["conv", "seg"]):
                parts = [_row_run(r["seg"], r["turn"], r["initial"], r["fault"], leaves) for r in group]
                yield {"conv": group[0]["conv"], **_join_runs(parts)}

        yield from _batched(rows(), schema)
    return run


def _round(schema: pa.Schema):
    def run(batches):
        rows = ({**_join_runs(g), "k": g[0]["to"]} for g in _grouped(batches, ["conv", "to"]))
        yield from _batched(({c: r[c] for c in schema.names} for r in rows), schema)
    return run


_REPORT = ("n long, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string")
_LONGEST = (1 << 63) - 1


def _reports(schema: pa.Schema):
    def run(batches):
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    r["cost"], r["audit"] = best(_unpacked(r["costs"], r["audits"]))
                    r["gaps"] = 0 if r["low"] is None else min(r["high"] - r["low"] + 1 - r["turns"], _LONGEST)
                    yield {c: r[c] for c in schema.names}
        yield from _batched(rows(), schema)
    return run


# ------------------------------------------------------------------------------ operator

def _ordered(rows: DataFrame) -> DataFrame:
    """The rows in conversation order with a written place ``pos`` that only grows along it.

    Rows that share conversation and turn follow role, the first 64 characters of the text, and the
    digest of the whole text; what ties there too is the same row.
    """
    keyed = rows.withColumns({"head": F.substring("text", 1, 64), "digest": F.md5("text"),
                              "tie": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "head", "digest", "tie"]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("pos"))
    return saved(placed.withColumn("seg", F.shiftright("pos", SEGMENT_BITS)), "conversation-rows")


def _faults(ordered: DataFrame) -> DataFrame:
    """(conv, seg, pos, turn, initial, fault): the first fault of each row, without its text."""
    last = F.right(F.rtrim(F.col("text"), F.lit(ASCII_SPACE)), F.lit(1))
    light = ordered.select(
        "conv", "seg", "pos", "turn", F.left("role", F.lit(1)).alias("initial"), last.alias("last"),
        F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text"))).alias("same"))
    filled = light.where("last <> ''")
    # The first row of each equal (role, text) of a conversation, joined back by its unique place.
    firsts = filled.groupBy("conv", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = (F.when(F.col("last") == "", BLANK).when(F.col("first").isNull(), DUPLICATE)
             .when(~F.col("last").isin(".", "!", "?"), CUT).otherwise(OK))
    return light.drop("same").join(firsts, "pos", "left").select(
        "conv", "seg", "pos", "turn", "initial", fault.cast("int").alias("fault"))


def _whole(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one run for each conversation, every run with its number ``k`` in its conversation)."""
    numbered = saved(runs.withColumn("k", F.row_number().over(Window.partitionBy("conv").orderBy("seg")) - 1), "conversation-runs")
    most = numbered.agg(F.max("k")).first()[0] or 0
    parts = numbered
    while most > 0:
        to = parts.withColumn("to", F.floor(F.col("k") / FAN).cast("int"))
        dealt = to.repartition("conv", "to").sortWithinPartitions("conv", "to", "k")
        parts = saved(dealt.mapInArrow(_round(_arrow(numbered.schema)), numbered.schema), "conversation-round")
        most //= FAN
    return parts, numbered


def _pieces(schema: pa.Schema):
    """A conversation's audit cut at its segments: letters up to a segment's last row, what was put out before."""
    def run(batches):
        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    audit, at, done = r["audit"], 0, 0
                    odd = (len(audit) - audit.count("D")) % 2
                    runs = sorted(r["runs"], key=lambda x: x["seg"])
                    for number, x in enumerate(runs):
                        end = at
                        for _ in range(x["n"]):
                            while audit[end] == "I":
                                end += 1
                            end += 1
                        if number + 1 == len(runs):
                            end = len(audit)
                        piece = audit[at:end]
                        yield {"conv": r["conv"], "seg": x["seg"], "letters": piece, "done": done, "odd": odd,
                               "alone": len(runs) == 1}
                        done += len(piece) - piece.count("D")
                        at = end
        yield from _batched(rows(), schema)
    return run


_REPAIRED = "seg long, alone boolean, place long, role string, text string, edit string"


def _repaired(schema: pa.Schema):
    """Rows of a partition sorted by (conv, seg, pos), each segment led by its piece of the audit."""
    def run(batches):
        def rows():
            piece, letters, place = None, iter(""), 0

            def line(edit, role, text):
                return {"conv": piece["conv"], "seg": piece["seg"], "alone": piece["alone"], "place": place, "role": role,
                        "text": text, "edit": edit}

            def due():  # the role that the pattern wants here
                return ROLES["ua"[(place - piece["odd"]) % 2]]

            for batch in batches:
                for r in batch.to_pylist():
                    if r["letters"] is not None:
                        for edit in letters:  # insertions behind the last row
                            yield line(edit, due(), "")
                            place += 1
                        piece, letters, place = r, iter(r["letters"]), r["done"]
                        continue
                    while (edit := next(letters)) == "I":
                        yield line(edit, due(), "")
                        place += 1
                    if edit != "D":
                        yield line(edit, r["role"] if edit == "K" else due(), r["text"])
                        place += 1
            for edit in letters:
                yield line(edit, due(), "")
                place += 1
        yield from _batched(rows(), schema)
    return run


def _blobs(schema: pa.Schema):
    """Digest of a conversation that is in one segment, else the segment's joined lines."""
    def run(batches):
        def rows():
            for group in _grouped(batches, ["conv", "seg"]):
                text = "\n".join(f"{r['role']}:{r['text']}" for r in group)
                alone = group[0]["alone"]
                yield {"conv": group[0]["conv"], "seg": group[0]["seg"], "lines": None if alone else text,
                       "sha256": hashlib.sha256(text.encode()).hexdigest() if alone else None}
        yield from _batched(rows(), schema, 16)
    return run


def _stream_digest(schema: pa.Schema):
    def run(batches):
        def rows():
            conv, digest = None, None
            for batch in batches:
                for r in batch.to_pylist():
                    if digest is None or r["conv"] != conv:
                        if digest is not None:
                            yield {"conv": conv, "sha256": digest.hexdigest()}
                        conv, digest = r["conv"], hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(r["lines"].encode())
            if digest is not None:
                yield {"conv": conv, "sha256": digest.hexdigest()}
        yield from _batched(rows(), schema)
    return run


class Repair:
    """Reports, repaired rows and their digests of conversations.

    ``rows`` holds one row for each turn; null roles and texts count as one space. Rows follow their
    turn (nulls first); equal turns follow role and text. Every row's first fault counts: blank,
    duplicate (role and text as an earlier row of the conversation), truncated. A null conversation id
    is a conversation of its own. Extra columns are not read. Conversations without rows are in no
    result; an empty table gives empty results. Turns are numbers, roles may be any text: initials
    other than s, u and a can only be changed or deleted.
    """

    def __init__(self, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text"):
        own = own_columns(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
        own = own.withColumn("turn", F.col("turn").cast("long"))
        own = own.withColumns({c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")})
        self.conv_type = own.schema["conv"].dataType.simpleString()
        self.rows = _ordered(own)
        self._report: DataFrame | None = None
        self._numbered: DataFrame | None = None

    def _typed(self, rest: str):
        schema = f"conv {self.conv_type}, {rest}"
        spark = self.rows.sparkSession
        parsed = spark.createDataFrame([], schema).schema
        return _arrow(parsed), parsed

    def report(self) -> DataFrame:
        """(conv, n, blank, duplicate, truncated, illegal, gaps, cost, audit), one row for each conversation.

        ``gaps`` is the number of turns missing between the lowest and the highest one.
        """
        if self._report is None:
            arrow, schema = self._typed(_RUN)
            dealt = _faults(self.rows).repartition("seg").sortWithinPartitions("pos")
            whole, self._numbered = _whole(dealt.mapInArrow(_runs(arrow), schema))
            arrow, schema = self._typed(_REPORT)
            self._report = saved(whole.mapInArrow(_reports(arrow), schema), "conversation-report")
        return self._report

    def _applied(self) -> DataFrame:
        report = self.report()
        runs = self._numbered.groupBy("conv").agg(F.collect_list(F.struct("seg", "n")).alias("runs"))
        cut = report.select(F.col("conv").alias("c"), "audit").join(runs, F.col("c").eqNullSafe(F.col("conv")))
        arrow, schema = self._typed("seg long, letters string, done long, odd int, alone boolean")
        pieces = cut.select("conv", "audit", "runs").mapInArrow(_pieces(arrow), schema)
        lead = pieces.select("conv", "seg", F.lit(-1).cast("long").alias("pos"), "letters", "done", "odd", "alone",
                             F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
        none = {"letters": "string", "done": "long", "odd": "int", "alone": "boolean"}
        body = self.rows.select("conv", "seg", "pos", *(F.lit(None).cast(t).alias(c) for c, t in none.items()), "role", "text")
        dealt = lead.unionByName(body).repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos")
        arrow, schema = self._typed(_REPAIRED)
        return dealt.mapInArrow(_repaired(arrow), schema)

    def repaired(self) -> DataFrame:
        """(conv, place, role, text, edit): the rows after repair, numbered from 0 in each conversation.

        ``edit`` is K (kept), R (role changed) or I (inserted, with an empty text).
        """
        return self._applied().select("conv", "place", "role", "text", "edit")

    def digests(self) -> DataFrame:
        """(conv, sha256) over the repaired ``role:text`` lines; conversations left without rows are absent."""
        arrow, schema = self._typed("seg long, lines string, sha256 string")
        blobs = saved(self._applied().mapInArrow(_blobs(arrow), schema), "conversation-lines")
        arrow, schema = self._typed("sha256 string")
        split = blobs.where("lines is not null").select("conv", "seg", "lines")
        streamed = split.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(_stream_digest(arrow), schema)
        return blobs.where("sha256 is not null").select("conv", "sha256").unionByName(streamed)


# What each remainder of the damage hash does.
DAMAGES, DROP, EMPTY, UNSTOP, REPEAT, TO_USER = 20, 0, 1, 2, 3, 4


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) after seeded damage by the CRC-32 of ``conv_id:turn`` (nulls: one space).

    Of every twenty remainders five do harm: the row goes, its text is emptied, its sentence ends go,
    it is repeated, or its role becomes user. Null roles and texts are one space. Rows that share
    conversation and turn are damaged alike. An empty table gives an empty table.
    """
    own = own_columns(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    h = F.crc32(key.cast("binary")) % DAMAGES
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    text = F.when(h == EMPTY, "").when(h == UNSTOP, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(h == DROP, 0).when(h == REPEAT, 2).otherwise(1)
    return own.select("conv_id", "turn", F.when(h == TO_USER, "user").otherwise(role).alias("role"), text.alias("text"),
                      F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")
