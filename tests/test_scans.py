"""Alignment operators that read their input once."""

import re

from pyspark.sql import functions as F

from spliceloom.functions import alignment as AL
from spliceloom.operators import assign as A


def walked(start, cigar):
    """(blocks, indels) of one alignment, step by step."""
    if cigar is None:
        return None, None
    add = lambda a, b: None if a is None else a + b
    at, s, pos, blocks, found = start, start, add(start, 1), [], []
    for n, op in re.findall(r"([0-9]+)([MIDNSHP=X])", cigar):
        n = int(n)
        if op == "N":
            blocks.append((s, at))
            s = add(at, n)
        if op in "ID":
            found.append(("insertion" if op == "I" else "deletion", pos, pos if op == "I" else add(pos, n - 1), n))
        at = add(at, n if op in "MD=XN" else 0)
        pos = add(pos, n if op in "MD=XNP" else 0)
    return [*blocks, (s, at)], found


def test_cigar_walk(spark):
    """Blocks and indels come from one vectorised pass, also for odd and missing texts."""
    cases = [(0, "5S10M1I2D8M100N7M5H"), (99, None), (7, ""), (7, "*"), (None, "3M2N4M1D2M"), (5, "M3M"), (5, "12A3M04N2="), (1, "3=2X1P4I2N1P1D9M"), (2, "5N6N7M"), (3, "10"), (4, "2Mä3D1M"), (0, "9M")] * 3
    df = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(cases)], "id long, s long, c string").repartition(2)
    out = df.select("id", AL.cigar_blocks(F.col("s"), F.col("c")).alias("b"), AL.indels(F.col("s"), F.col("c")).alias("i"))
    got = {r["id"]: (None if r["b"] is None else [tuple(x) for x in r["b"]], None if r["i"] is None else [tuple(x) for x in r["i"]]) for r in out.collect()}
    assert got == {i: walked(s, c) for i, (s, c) in enumerate(cases)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"walked\(", plan.split("ArrowEvalPython", 1)[1].split("]")[0])) == 1 and "aggregate(" not in plan


def test_indels_near_junctions_reads_once(spark):
    """The pairs and the totals of indels follow from one pass over the alignments."""
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for b in rows:
            seen.add(len(b))
            yield b

    reads = [("c", [(10, 20), (18, 30)], [("deletion", 15, 16, 2), ("insertion", 90, 90, 1)]), ("c", [(10, 20), (10, 20)], [("deletion", 15, 16, 2)]),
             ("c", [], [("deletion", 15, 16, 2)]), ("d", [(10, 20)], [("deletion", 15, 16, 2)]), ("d", [(1, 99)], []), ("d", None, [("deletion", 15, 16, 2)])]
    schema = "chrom string, junctions array<struct<s:long,e:long>>, indels array<struct<kind:string,pos:long,end:long,n:long>>"
    out = A.indels_near_junctions(spark.createDataFrame(reads, schema).mapInPandas(counted, schema), 6)
    got = sorted(tuple(r) for r in out.select("chrom", "a", "b", "indel", "n").collect())
    assert got == [("c", 10, 20, "deletion:15:2", 3), ("c", 18, 30, "deletion:15:2", 3), ("d", 10, 20, "deletion:15:2", 2)]
    assert seen.value == len(reads)
