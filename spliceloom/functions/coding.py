"""Peptide features and the coding score. The ORF scan and the Fickett score are Spark expressions in `sequence`."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from spliceloom.functions.sequence import fickett, longest_orf

# The standard genetic code with bases in the order T, C, A, G.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# pK of side chains and chain ends for the isoelectric point.
PK_POSITIVE = {"K": 10.0, "R": 12.0, "H": 5.98}
PK_NEGATIVE = {"D": 4.05, "E": 4.45, "C": 9.0, "Y": 10.0}
PK_N_END, PK_C_END = 7.5, 3.55
PK_N_END_BY = {"A": 7.59, "M": 7.0, "S": 6.93, "P": 8.36, "T": 6.82, "V": 7.44, "E": 7.7}
PK_C_END_BY = {"D": 4.55, "E": 4.75}
MODEL_ROWS = 100_000  # vectors of a coding model, four numbers each
# Feature ranges of the scaled coding model (peptide length, Fickett, pI, ORF integrity).
RANGES = [(0.0, 14507.0), (0.22328, 0.51262), (0.0, 13.2714233398), (-1.0, 1.0)]


def _codon_table() -> dict[str, str]:
    bases = "TCAG"
    return {a + b + c: CODE[16 * i + 4 * j + k] for i, a in enumerate(bases) for j, b in enumerate(bases) for k, c in enumerate(bases)}


def peptide(cds: Column) -> Column:
    """Translation of whole codons; unknown codons are X, stops *."""
    table = F.create_map(*[F.lit(x) for pair in _codon_table().items() for x in pair])
    codons = F.regexp_extract_all(cds, F.lit("(?s)(.{3})"), 1)
    return F.array_join(F.transform(codons, lambda c: F.coalesce(F.try_element_at(table, c), F.lit("X"))), "")


@F.pandas_udf(DoubleType())
def isoelectric_point(protein: pd.Series) -> pd.Series:
    """pH of zero net charge by bisection over all rows of a batch at once; 0 for an empty peptide."""
    p = protein.fillna("").str.replace("[XBZJU]", "", regex=True).str.strip("*")
    first, last = p.str[:1], p.str[-1:]
    plus = [(np.full(len(p), 1.0), first.map(PK_N_END_BY).fillna(PK_N_END).to_numpy(float))]
    minus = [(np.full(len(p), 1.0), last.map(PK_C_END_BY).fillna(PK_C_END).to_numpy(float))]
    plus += [(p.str.count(a).to_numpy(float), np.full(len(p), k)) for a, k in PK_POSITIVE.items()]
    minus += [(p.str.count(a).to_numpy(float), np.full(len(p), k)) for a, k in PK_NEGATIVE.items()]
    lo, hi = np.full(len(p), 0.0), np.full(len(p), 14.0)
    for _ in range(60):
        ph = (lo + hi) / 2
        charge = sum(n / (1 + 10 ** (ph - k)) for n, k in plus) - sum(n / (1 + 10 ** (k - ph)) for n, k in minus)
        lo, hi = np.where(charge > 0, ph, lo), np.where(charge > 0, hi, ph)
    return pd.Series(np.where(p.str.len() > 0, (lo + hi) / 2, 0.0))


def coding_features(seqs: DataFrame, extra: dict | None = None) -> DataFrame:
    """id, length, orf_start (1-based, 0 if none), orf_length, pep_len, fickett, pi, integrity, and a column for each function of the text in ``extra``. Input: id, seq."""
    s = seqs.select("id", F.translate(F.upper("seq"), "U", "T").alias("seq"))
    o = s.withColumn("orf", longest_orf(F.col("seq")))
    n = (F.col("orf.end") - F.col("orf.start")).cast("int")
    rows = o.withColumn("pep", peptide(F.substring(F.col("seq"), F.col("orf.start") + 1, n)))
    found = F.length("pep") > 0
    more = [of(F.col("seq")).alias(name) for name, of in (extra or {}).items()]
    return rows.select("id", F.length("seq").alias("length"), F.when(found, F.col("orf.start") + 1).otherwise(0).alias("orf_start"), n.alias("orf_length"), *more,
                       F.length("pep").alias("pep_len"), fickett(F.col("seq")).alias("fickett"),
                       isoelectric_point("pep").alias("pi"), F.when(found, F.col("orf.integrity")).otherwise(-1).alias("integrity"))


def coding_probability(features: DataFrame, vectors: np.ndarray, weights: np.ndarray, gamma: float, rho: float,
                       prob_a: float, prob_b: float) -> DataFrame:
    """Score rows by a kernel machine given by the user: `vectors` (n x 4, scaled), their weights and the sigmoid values.

    The machine is a small fixed model: more than MODEL_ROWS vectors are an error, so what travels with the function is bounded. The label follows the
    probability: coding above one half.
    """
    sv, w = np.asarray(vectors, float), np.asarray(weights, float)
    if len(sv) > MODEL_ROWS:
        raise ValueError(f"a coding model has at most {MODEL_ROWS} vectors")
    lo = np.array([r[0] for r in RANGES])
    hi = np.array([r[1] for r in RANGES])

    @F.pandas_udf(DoubleType())
    def decide(pep: pd.Series, fick: pd.Series, pi: pd.Series, integrity: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float) for c in (pep, fick, pi, integrity)])
        x = -1 + 2 * (x - lo) / (hi - lo)
        out = np.empty(len(x))
        for i in range(0, len(x), 512):
            part = x[i:i + 512]
            d = ((part[:, None, :] - sv[None, :, :]) ** 2).sum(axis=2)
            out[i:i + 512] = np.exp(-gamma * d) @ w - rho
        return pd.Series(out)

    out = features.withColumn("decision", decide("pep_len", "fickett", "pi", "integrity"))
    return (out.withColumn("coding_probability", 1 / (1 + F.exp(F.lit(prob_a) * F.col("decision") + F.lit(prob_b))))
               .withColumn("coding_label", F.when(F.col("coding_probability") > 0.5, "coding").otherwise("noncoding")).drop("decision"))
