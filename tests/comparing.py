"""Compare a Spark query with its SQL."""


def same_rows(df, sql, con):
    """Rows of a Spark query and of its SQL, as multisets."""
    import pandas as pd

    got, want = df.toPandas(), con.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    a, b = (x[columns].sort_values(columns, ignore_index=True) for x in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
