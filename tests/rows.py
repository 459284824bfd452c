"""Input rows shared by the tests."""

SF0001 = "/root/testdata/sf0.001"


def raw_frame(spark, rows):
    """Mini raw transactions: (invoiceno, stockcode, quantity, invoicedate, unitprice, customerid, country)."""
    import datetime as dt

    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("invoiceno", T.StringType()),
            T.StructField("stockcode", T.StringType()),
            T.StructField("quantity", T.DoubleType()),
            T.StructField("invoicedate", T.TimestampNTZType()),
            T.StructField("unitprice", T.DoubleType()),
            T.StructField("customerid", T.StringType()),
            T.StructField("country", T.StringType()),
        ]
    )
    conv = []
    for r in rows:
        r = list(r)
        if isinstance(r[3], str):
            r[3] = dt.datetime.fromisoformat(r[3])
        conv.append(tuple(r))
    return spark.createDataFrame(conv, schema)
