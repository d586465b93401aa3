"""Cluster text with many members in a record."""

from segtrace.sources.readers import read_clusters


def test_record_is_cut_once(spark, tmp_path):
    """The work on a record may not be done again for each of its lines: nothing above the explode sees the whole record."""
    lines = ["0\t400nt, >A0... *", *(f"{k}\t400nt, >A{k}... at +/99.50%" for k in range(1, 3000))]
    (tmp_path / "clusters").write_text(">Cluster 7\r\n" + "\r\n".join(lines) + "\n>Cluster 8\n0\t9aa, >B... *\n")
    df = read_clusters(spark, str(tmp_path))
    above = df._jdf.queryExecution().optimizedPlan().toString().partition("Generate")[0]
    assert "value" not in above and "split" not in above
    rows = df.collect()
    assert len(rows) == 3001 and {r.cluster for r in rows} == {">Cluster 7", ">Cluster 8"}
    assert {(r.member_idx, r.accession) for r in rows if r.cluster == ">Cluster 7"} == {(k, f"A{k}") for k in range(3000)}
