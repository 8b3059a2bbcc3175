"""Packing documents into sequences of a fixed number of tokens.

Only lengths matter to a packing, and there are at most ``size`` of them. So the plan is
made on a table of counts per length, whose size does not depend on the data, by bin
completion: take the largest length left, enumerate the fillings around it, prune those
that cannot beat the best one by their waste, replace dominated ones by those that dominate them,
and use the filling as often as the counts allow. Best-fit fillings are the incumbents. A plan whose waste can no longer beat the best
plan is given up, and the search goes back to the next filling of its last bins.

The pieces are then numbered within their length, in parallel, and look up the place that
the plan gave to their number. So a plan of some thousand lines packs any number of rows.

Defined results: NULL counts as empty, and an empty text is a document of one end token.
Repeated rows are documents of their own. Documents longer than a sequence are cut into
full pieces behind a first, possibly shorter one. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import pick, slices
from starflow.llm.tokens import encoder, tokenizer_path
from starflow.operators.keys import number_by_order
from starflow.sources.workspace import Workspace

SEQUENCE = 2048
END_ID = 0
FILLING_STEPS = 4000  # nodes visited per enumeration of fillings
PLAN_STEPS = 20_000  # plan lines tried in all
BACK_STEPS = 300_000  # nodes visited in all once there is a plan, to find a better one
CALL_STEPS = 200  # what setting up one enumeration costs, in nodes
FILLINGS = 3  # alternatives kept per bin, for going back


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) per piece; ids are little-endian bytes."""
    path = tokenizer or tokenizer_path()
    rows = pick(docs, id=doc_id, text=text)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = end_id.to_bytes(4, "little")

    def run(batches) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in slices(batches):
            which, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, content in enumerate(batch.column(1).to_pylist()):
                tokens = encode(content or "") + end
                n, at = len(tokens) // 4, 0
                stop = (n - 1) % size + 1
                while at < n:
                    part = tokens[4 * at : 4 * stop]
                    piece.append(0 if at == 0 else piece[-1] + 1)
                    which.append(row)
                    start.append(at)
                    length.append(stop - at)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
                    at, stop = stop, stop + size
            columns = [
                batch.column(0).take(pa.array(which, pa.int64())),
                pa.array(piece, pa.int32()),
                *[pa.array(x, pa.int64()) for x in (start, length, crc)],
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema + (", ids binary" if with_ids else ""))


@dataclass
class Line:
    """``times`` sequences that are filled alike; ``fill`` is [(length, uses), ...]."""

    fill: list[tuple[int, int]]
    times: int
    waste: int


def fillings(
    counts: list[int], room: int, steps: int = FILLING_STEPS, keep: int = FILLINGS
) -> tuple[list[tuple[int, list[tuple[int, int]]]], int]:
    """(fillings, nodes visited): the best fillings of ``room``, least waste first, as [(length, uses), ...].

    Lengths are tried from the largest down, each with every number of uses that fits. A
    branch is pruned if even the lengths left for it cannot undercut the waste known. A filling that
    is dominated gives way to the one that dominates it. The best-fit filling is the incumbent.
    """
    best: list[tuple[int, list[tuple[int, int]]]] = []
    sizes = [n for n in range(min(room, len(counts) - 1), 0, -1) if counts[n]]
    rising = sizes[::-1]
    reach = [0] * (len(sizes) + 1)  # all that the lengths from here on hold
    for i in range(len(sizes) - 1, -1, -1):
        reach[i] = reach[i + 1] + sizes[i] * counts[sizes[i]]
    fits: list[int] = []  # place of the largest length that fits, by room
    for i, n in enumerate(rising):
        fits += [len(sizes) - i] * (n - len(fits))
    fits += [0] * (room + 1 - len(fits))
    budget = [steps]

    def offer(waste: int, fill: list[tuple[int, int]]) -> None:
        if len(best) == keep and waste >= best[-1][0]:
            return
        waste, fill = undominated(counts, rising, waste, fill)
        if (waste, fill) in best:
            return
        best.append((waste, fill))
        best.sort(key=lambda x: (x[0], sum(u for _, u in x[1])))
        del best[keep:]

    def search(i: int, left: int, fill: list[tuple[int, int]]) -> None:
        offered = False
        i = max(i, fits[left])
        while i < len(sizes) and budget[0] > 0:
            if best and best[0][0] == 0:
                return
            if len(best) == keep and max(0, left - reach[i]) >= best[-1][0]:
                return
            length = sizes[i]
            budget[0] -= 1
            offered = True
            for uses in range(min(counts[length], left // length), 0, -1):
                search(i + 1, left - uses * length, [*fill, (length, uses)])
                if budget[0] <= 0 or (best and best[0][0] == 0):
                    return
            i += 1
        if not offered:
            offer(left, fill)

    offer(*best_fit(counts, room))
    search(0, room, [])
    return best, steps - budget[0]


def undominated(
    counts: list[int], rising: list[int], waste: int, fill: list[tuple[int, int]]
) -> tuple[int, list[tuple[int, int]]]:
    """The filling, or one that dominates it: parts given up for a longer part that is still free.

    One part, or two together, may be replaced by one that is at least as long and fits, and a
    part may be added: the filling gets fuller, or has fewer parts, so this ends.
    """
    uses = dict(fill)
    changed = True
    while changed:
        changed = False
        parts = sorted(uses)
        alone = ((n, (n,)) for n in parts)
        twice = ((a + b, (a, b)) for i, a in enumerate(parts) for b in parts[i:] if a != b or uses[a] > 1)
        for given, taken in itertools.chain([(0, ())], alone, twice):
            least = given + (len(taken) < 2)
            at = bisect.bisect_left(rising, least)
            while at < len(rising) and rising[at] <= given + waste:
                longer = rising[at]
                if counts[longer] > uses.get(longer, 0):
                    for n in taken:
                        uses[n] -= 1
                        if not uses[n]:
                            del uses[n]
                    uses[longer] = uses.get(longer, 0) + 1
                    waste -= longer - given
                    changed = True
                    break
                at += 1
            if changed:
                break
    return waste, sorted(uses.items(), reverse=True)


def fullest(lengths: Iterable[int], size: int) -> int:
    """The most that any sequence can hold: the largest sum of lengths that is not above ``size``."""
    sums, all_ = 1, (1 << (size + 1)) - 1
    for n in lengths:
        step = n
        while step <= size:
            sums |= (sums << step) & all_
            step *= 2
    return sums.bit_length() - 1


def best_fit(counts: list[int], room: int) -> tuple[int, list[tuple[int, int]]]:
    """(waste, filling) of always taking the largest length that still fits."""
    fill = []
    for length in range(min(room, len(counts) - 1), 0, -1):
        uses = min(counts[length], room // length)
        if uses:
            fill.append((length, uses))
            room -= uses * length
    return room, fill


def plan_packing(counts: dict[int, int], size: int = SEQUENCE, steps: int = PLAN_STEPS) -> list[Line]:
    """Lines that use up all counts, in as few sequences as the search finds.

    Room that no sum of the lengths can reach is no waste: it is left out from the start. The
    best-fit plan is the incumbent, so the search can only do better.
    """
    counts = {length: n for length, n in counts.items() if n}
    if not counts:
        return []
    size = fullest(counts, size)
    left = [0] * (size + 1)
    for length, n in counts.items():
        left[length] = n
    total = sum(length * n for length, n in counts.items())
    least = -(-total // size)
    best = _by_best_fit(list(left), size)
    used = sum(line.times for line in best)
    if used <= least:
        return best
    allowed = (used - 1) * size - total  # waste that a better plan may have
    descended = False
    lines: list[Line] = []
    choices: list[list] = []  # per line, the fillings not tried yet
    waste, top, back = 0, size, BACK_STEPS

    def use(line: Line, sign: int) -> None:
        for length, uses in line.fill:
            left[length] -= sign * uses * line.times

    while steps > 0 and back > 0:
        while top and not left[top]:
            top -= 1
        dead = waste > allowed
        if top and not dead:
            left[top] -= 1
            found, nodes = fillings(left, size - top)
            left[top] += 1
            if descended:
                back -= nodes + CALL_STEPS
            options = [_merge(top, fill) for _, fill in found]
        elif not dead:  # all is packed
            best = list(lines)
            used = sum(line.times for line in best)
            if used <= least:
                break
            allowed = (used - 1) * size - total
            dead = True
        if dead:
            descended = True
            while choices and not choices[-1]:
                choices.pop()
                line = lines.pop()
                waste -= line.waste
                use(line, -1)
            if not choices:
                break
            line = lines.pop()
            waste -= line.waste
            use(line, -1)
            options = choices.pop()
            top = size
        fill, rest = options[0], options[1:]
        times = min(left[length] // uses for length, uses in fill)
        if rest and descended:
            times = 1 if times < 8 else times
        line = Line(fill, times, times * (size - sum(n * u for n, u in fill)))
        lines.append(line)
        choices.append(rest)
        waste += line.waste
        use(line, 1)
        steps -= 1
    return best


def _by_best_fit(left: list[int], size: int) -> list[Line]:
    """The plan that takes the largest length that still fits, always. Uses ``left`` up."""
    lines = []
    for length in range(size, 0, -1):
        while left[length]:
            left[length] -= 1
            waste, rest = best_fit(left, size - length)
            left[length] += 1
            fill = _merge(length, rest)
            times = min(left[n] // u for n, u in fill)
            for n, u in fill:
                left[n] -= u * times
            lines.append(Line(fill, times, waste * times))
    return lines


def _merge(length: int, fill: list[tuple[int, int]]) -> list[tuple[int, int]]:
    uses = dict(fill)
    uses[length] = uses.get(length, 0) + 1
    return sorted(uses.items(), reverse=True)


def _places(lines: list[Line]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, numbers, first sequence, uses, offset) per part of a line."""
    out, used, sequence = [], {}, 0
    for line in lines:
        offset = 0
        for length, uses in line.fill:
            first = used.get(length, 0)
            out.append((length, first, uses * line.times, sequence, uses, offset))
            used[length] = first + uses * line.times
            offset += length * uses
        sequence += line.times
    return out


def pack_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    size: int = SEQUENCE,
    workspace: Workspace | None = None,
    **options,
) -> DataFrame:
    """The pieces, each with its sequence_id and its offset there."""
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    found = pieces(docs, doc_id, text, size=size, **options)
    # The row number tells repeated rows apart, so that they are split over tasks too.
    order = [F.col(c) for c in ("length", "id", "piece", "ids_crc32", "_row")]
    stored = workspace.store(found, "pieces", row_id="_row")
    numbered = number_by_order(stored, order, "_n", workspace)
    # At most one row per length.
    counts = {r[0]: r[1] for r in numbered.groupBy("length").count().collect()}
    before, firsts = 0, []
    for length in sorted(counts):
        firsts.append((length, before))
        before += counts[length]
    shorter = dict(firsts)
    places = [
        (length, shorter[length] + first, shorter[length] + first + n, sequence, uses, offset)
        for length, first, n, sequence, uses, offset in _places(plan_packing(counts, size))
    ]
    plan = spark.createDataFrame(
        places, "_length bigint, _from bigint, _to bigint, _sequence bigint, _uses bigint, _offset bigint"
    )
    number = F.col("_n") - 1
    # The plan has a bounded number of lines: PLAN_STEPS and one more per length.
    placed = numbered.join(
        F.broadcast(plan),
        (F.col("length") == F.col("_length")) & (number >= F.col("_from")) & (number < F.col("_to")),
    )
    inside = number - F.col("_from")
    return placed.select(
        F.col("id").alias(doc_id),
        *[c for c in found.columns if c != "id"],
        (F.col("_sequence") + F.floor(inside / F.col("_uses"))).alias("sequence_id"),
        (F.col("_offset") + (inside % F.col("_uses")) * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed ``with_ids``; a sequence is bounded by its size."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_, p: F.concat(all_, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
