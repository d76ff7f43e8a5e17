"""Three numbers packed in one non-negative 64-bit id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bit widths of the id layout, high to low.
SEQUENCE_BITS = 18
PARTITION_BITS = 24
TASK_BITS = 21
# Fixed value: low bits of the sequence number that hold the attempt in the attempt-carrying form.
ATTEMPT_BITS = 6


def _checked(col: Column, bits: int, what: str) -> Column:
    """The column as LONG, or an error if it is outside [0, 2^bits)."""
    value = col.cast("long")
    top = (1 << bits) - 1
    bad = F.concat(F.lit(f"{what} out of range 0..{top}: "), value.cast("string"))
    return F.when((value < 0) | (value > top), F.raise_error(bad).cast("long")).otherwise(value)


def pack_id(seq: Column, part: Column, task: Column) -> Column:
    high = F.shiftleft(_checked(seq, SEQUENCE_BITS, "sequence"), PARTITION_BITS + TASK_BITS)
    middle = F.shiftleft(_checked(part, PARTITION_BITS, "partition"), TASK_BITS)
    return high.bitwiseOR(middle).bitwiseOR(_checked(task, TASK_BITS, "task"))


def unpack_id(packed: Column) -> dict[str, Column]:
    """Columns ``seq``, ``part`` and ``task`` of a packed id."""
    def field(shift: int, bits: int) -> Column:
        return F.shiftright(packed, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))

    return {
        "seq": field(PARTITION_BITS + TASK_BITS, SEQUENCE_BITS),
        "part": field(TASK_BITS, PARTITION_BITS),
        "task": field(0, TASK_BITS),
    }


def pack_attempt_id(seq: Column, part: Column, task: Column, attempt: Column) -> Column:
    """Packed id whose sequence field is ``seq`` followed by the attempt number in its low bits."""
    numbered = F.shiftleft(seq.cast("long"), ATTEMPT_BITS).bitwiseOR(_checked(attempt, ATTEMPT_BITS, "attempt"))
    return pack_id(numbered, part, task)


def unpack_attempt(packed: Column) -> dict[str, Column]:
    """Columns ``seq``, ``part``, ``task`` and ``attempt`` of an id made by ``pack_attempt_id``."""
    fields = unpack_id(packed)
    attempt = fields["seq"].bitwiseAND(F.lit((1 << ATTEMPT_BITS) - 1).cast("long"))
    return {**fields, "seq": F.shiftright(fields["seq"], ATTEMPT_BITS), "attempt": attempt}
