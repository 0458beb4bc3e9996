"""Sets of transaction ids: reading their text, membership, starting behind one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flavour(text: str) -> str:
    return "" if not text else "mysql" if ":" in text else "mariadb"


def parsed(text: str) -> dict[str, list[tuple[int, int]]]:
    """Intervals by source: ``uuid:1-5:7, uuid:9`` or, by domain, ``0-1-100``, which has all numbers of its domain up to 100. Other text is an error."""
    out: dict[str, list[tuple[int, int]]] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        if ":" in part:
            uuid, *ranges = part.split(":")
            for r in ranges:
                lo, _, hi = r.partition("-")
                out.setdefault(uuid.lower(), []).append((int(lo), int(hi or lo)))
        else:
            domain, _, number = part.split("-")
            out.setdefault(domain, []).append((0, int(number)))
    for uuid, ranges in out.items():
        if any(lo > hi for lo, hi in ranges):
            raise ValueError(f"an interval of {uuid} ends before it starts")
    return {u: merged(r) for u, r in out.items()}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def written(sets: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(":".join([u, *(str(lo) if lo == hi else f"{lo}-{hi}" for lo, hi in r)]) for u, r in sorted(sets.items()))


def contains(text: str, gtid: Column) -> Column:
    """Whether the set has the id, which is ``uuid:number`` or ``domain-server-number``; a null id isn't in it."""
    found = F.lit(False)
    by_uuid = flavour(text) == "mysql"
    key = F.lower(F.split_part(gtid, F.lit(":"), F.lit(1))) if by_uuid else F.split_part(gtid, F.lit("-"), F.lit(1))
    number = (F.split_part(gtid, F.lit(":"), F.lit(2)) if by_uuid else F.split_part(gtid, F.lit("-"), F.lit(3))).try_cast("long")
    for source, ranges in parsed(text).items():
        here = F.lit(False)
        for lo, hi in ranges:
            here = here | number.between(lo, hi)
        found = found | ((key == source) & here)
    return F.coalesce(found, F.lit(False))


def behind(ops: DataFrame, text: str) -> DataFrame:
    """Operations of transactions that the set doesn't have."""
    return ops.where(~contains(text, F.col("gtid"))) if text else ops
