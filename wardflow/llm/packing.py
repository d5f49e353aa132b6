"""Vector bin packing of examples into training sequences.

Every example demands tokens, one segment and loss-bearing tokens; a sequence has a limit on
each. Sequences are filled one after the other: of the examples that fit, the next is the one
whose demand has the greatest dot product with the room that is left, each dimension weighted
by its average demand. Where nothing fits any more, the largest example is cut to the rest.

Packing is local to a partition and runs over it in windows, so there is no shuffle and memory
does not grow with the partition. What a window leaves over moves on to the next one; only the
last window of a partition has a rest, which is cut into powers of two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wardflow.llm.bpe import codec, read_spec, texts_of


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most."""

    tokens: int = 2048
    segments: int = 2048
    loss: int = 2048

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit must be at least 1")


WINDOW_TOKENS = 1 << 19    # tokens that are packed together
WINDOW_EXAMPLES = 1 << 15  # examples that are packed together: very short ones end a window early
PART_CHARS = 1 << 20       # characters that are encoded at a time; a longer text is alone
SEQUENCE_BITS = 33         # of a sequence id, below the partition's number


@dataclass
class Example:
    """A part of a row's ids: ``loss`` of its tokens, the last ones, bear loss."""

    row: int
    start: int
    length: int
    loss: int


def pack_window(examples: list[Example], limits: Limits, last: bool
                ) -> tuple[list[list[Example]], list[Example]]:
    """Sequences, and what is left for the next window (nothing if it is the ``last``).

    Examples of one demand are alike, so the search is among the different demands, and an
    example is taken as often in a row as its demand stays the best.
    """
    sequences: list[list[Example]] = []
    kinds: dict[tuple[int, int], list[Example]] = {}
    for e in examples:
        # What fills a sequence alone needs no search.
        while e is not None and (e.length >= limits.tokens or e.loss > limits.loss):
            head, e = _cut(e, _longest(e, limits.tokens, limits.loss))
            if head.length == limits.tokens:
                sequences.append([head])
            else:
                kinds.setdefault((head.length, head.loss), []).append(head)
        if e is not None and e.length:
            kinds.setdefault((e.length, e.loss), []).append(e)
    if not kinds:
        return sequences, []
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    row_of = {kind: i for i, kind in enumerate(sorted(kinds, reverse=True))}
    stacks = [kinds[kind][::-1] for kind in row_of]
    demand = np.array([(length, 1, loss) for length, loss in row_of], float)
    count = np.array([len(s) for s in stacks])
    weight = count @ demand / count.sum() / cap ** 2
    left = int(count @ demand[:, 0])
    while left >= limits.tokens or (last and left > 0):
        room, chosen = cap.copy(), []
        if left < limits.tokens:
            # The rest of a partition: a power of two needs no padding.
            room[0] = 1 << (left.bit_length() - 1)
        while room.min() > 0 and count.any():
            fits = (count > 0) & (demand <= room).all(1)
            if fits.any():
                score = np.where(fits, demand @ (weight * room), -1)
                i = int(np.argmax(score))
                n = _in_a_row(i, score, demand, weight, room, int(count[i]))
                chosen += [stacks[i].pop() for _ in range(n)]
                room -= n * demand[i]
                count[i] -= n
                continue
            i = int(np.argmax(np.where(count > 0, demand[:, 0], -1)))
            e = stacks[i][-1]
            head, rest = _cut(e, _longest(e, int(room[0]), int(room[2])))
            if not head.length:
                break
            chosen.append(head)
            room -= (head.length, 1, head.loss)
            stacks[i].pop()
            count[i] -= 1
            kind = rest.length, rest.loss
            j = row_of.get(kind)
            if j is None and not count[i]:
                # The place of a demand that nobody has any more.
                del row_of[int(demand[i, 0]), int(demand[i, 2])]
                j, demand[i] = i, (rest.length, 1, rest.loss)
            elif j is None:
                j = len(stacks)
                stacks.append([])
                demand, count = np.vstack([demand, (rest.length, 1, rest.loss)]), np.append(count, 0)
            row_of[kind] = j
            stacks[j].append(rest)
            count[j] += 1
        sequences.append(chosen)
        left -= sum(e.length for e in chosen)
    return sequences, sorted((e for s in stacks for e in s), key=lambda e: (e.row, e.start))


def _in_a_row(i: int, score: np.ndarray, demand: np.ndarray, weight: np.ndarray, room: np.ndarray,
              count: int) -> int:
    """How often the best demand ``i`` is taken before it does not fit or another is better.

    Each time the scores fall by the products with ``i``'s demand, so they are lines."""
    needs = demand[i] > 0
    most = min(count, int((room[needs] // demand[i, needs]).min()))
    if most == 1:
        return 1
    fall = demand @ (weight * demand[i])
    slower = (score >= 0) & (fall < fall[i])
    if slower.any():
        most = min(most, 1 + int(((score[i] - score[slower]) / (fall[i] - fall[slower])).min()))
    return most


def _longest(e: Example, tokens: int, loss: int) -> int:
    """Longest head of the example within both limits."""
    return min(e.length, tokens, e.length - e.loss + loss)


def _cut(e: Example, length: int) -> tuple[Example, Example | None]:
    quiet = e.length - e.loss
    head = Example(e.row, e.start, length, max(0, length - quiet))
    if length == e.length:
        return head, None
    return head, Example(e.row, e.start + length, e.length - length, e.loss - head.loss)


def _pack(rows: Iterator[tuple[int, bytes, int]], limits: Limits, partition: int
          ) -> Iterator[tuple[list, list]]:
    """(key, packed ids, loss-bearing ids) -> pieces (key, start, ids, loss, total, sequence, offset)."""
    held: dict[int, list] = {}
    waiting: list[Example] = []
    tokens = number = count = fresh = 0
    window = max(WINDOW_TOKENS, 2 * limits.tokens)

    def flush(last: bool) -> list[tuple]:
        nonlocal waiting, tokens, number, fresh
        sequences, waiting = pack_window(waiting, limits, last)
        out = []
        for s in sequences:
            offset = 0
            for e in s:
                key, ids = held[e.row]
                out.append((key, e.start, ids[4 * e.start:4 * (e.start + e.length)], e.loss, len(ids) // 4,
                            partition << SEQUENCE_BITS | number, offset))
                offset += e.length
            number += 1
        for row in held.keys() - {e.row for e in waiting}:
            del held[row]
        tokens, fresh = sum(e.length for e in waiting), 0
        return out

    for key, ids, loss in rows:
        held[count] = [key, ids]
        waiting.append(Example(count, 0, len(ids) // 4, loss))
        count += 1
        fresh += 1
        tokens += len(ids) // 4
        if tokens >= window or fresh >= WINDOW_EXAMPLES:
            yield flush(False)
    yield flush(True)


def pack_texts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
               end_id: int | None = 1, limits: Limits = Limits(), loss_from: str | None = None
               ) -> DataFrame:
    """One row per piece: ``key``, start, length, ids (packed little-endian unsigned 32-bit),
    loss (how many of its last ids bear loss), doc_tokens, sequence_id, offset. Each id of each row's text lies in exactly one piece.

    ``end_id`` follows every text (null and empty ones consist of it; without an ``end_id``
    they have no piece). ``loss_from`` names a column with the number of leading tokens that
    bear no loss (null: none); without it all tokens bear loss. A text longer than a sequence
    is cut. Repeated rows and repeated or null keys are packed like any other row. Many empty or
    very short texts cost as much as their number, an empty table has no pieces. Columns
    besides those named play no part, so their names cannot clash.
    """
    columns = [df[key].alias("key"), df[text].alias("text")]
    if loss_from:
        columns.append(df[loss_from].cast("long").alias("quiet"))
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    tail = b"" if end_id is None else np.uint32(end_id).tobytes()
    kind = df.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("loss", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        coder = codec(spec.value)
        for batch in batches:
            for part in _parts(batch):
                packed = coder.encode_many(texts_of(part, "text"))
                quiet = part.column("quiet").to_pylist() if loss_from else [0] * len(packed)
                for k, ids, q in zip(part.column("key").to_pylist(), packed, quiet, strict=True):
                    n = (len(ids) + len(tail)) // 4
                    if n:
                        yield k, ids + tail, n - min(max(q or 0, 0), n)
        coder.forget()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for pieces in _pack(rows(batches), limits, TaskContext.get().partitionId()):
            types = types or _arrow_type(kind)
            for at in range(0, len(pieces), 2000):
                ks, starts, ids, losses, totals, sequences, offsets = zip(*pieces[at:at + 2000], strict=True)
                long = pa.int64()
                yield pa.RecordBatch.from_arrays([
                    pa.array(ks, types), pa.array(starts, long),
                    pa.array([len(i) // 4 for i in ids], long), pa.array(ids, pa.binary()),
                    pa.array(losses, long), pa.array(totals, long), pa.array(sequences, long), pa.array(offsets, long)],
                    names=schema.names)

    return df.select(*columns).mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in runs of bounded characters."""
    begin = chars = 0
    for i, n in enumerate(pc.utf8_length(batch.column("text")).to_pylist()):
        if i > begin and chars + (n or 0) > PART_CHARS:
            yield batch.slice(begin, i - begin)
            begin, chars = i, 0
        chars += n or 0
    if batch.num_rows:
        yield batch.slice(begin)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)
