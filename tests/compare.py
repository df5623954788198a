"""Spark result against the SQL of a query, as sorted rows with columns by name."""

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(tuple(row) for row in ([repr(v) for v in r] for r in rows))


def spark_rows(df):
    names = sorted(df.columns)
    return names, plain(df.select(*[f"`{n}`" for n in names]).collect())


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], plain([r[i] for i in order] for r in result.fetchall())
