"""A few registered queries against their SQL on the smallest data folder, and the registry itself."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
PICKED = ["ir_events", "a3ss_events", "read_assignment", "overlap_pairs_split_hot_cells", "novel_locus_names", "splice_motifs", "tail_length_tests", "adjusted_p_values",
          "isoform_feature_table", "decided_strands", "sam_blocks", "short_read_skips", "haplotype_files", "fastq_records", "subtracted_blocks"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", PICKED)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    norm = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    got = sorted(repr([norm(r[c]) for c in cols]) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted(repr([norm(dict(zip(names, r))[c]) for c in cols]) for r in cur.fetchall())
    assert got == want


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
