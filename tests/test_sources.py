import os
import tempfile

from quarry.sources import readers, schemas, sinks


def _write(text):
    d = tempfile.mkdtemp(prefix="quarry-csv-")
    p = os.path.join(d, "f.csv")
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_csv_with_header_and_bulk_cast(spark):
    p = _write("IDpol,ClaimNb,Exposure,VehPower,VehAge,DrivAge,BonusMalus,Density,Area,VehBrand,"
               "VehGas,Region\n1,0,0.1,5,0,55,50,1217,D,B12,Regular,R82\n2,x,1,6,2,46,50,54,B,B12,"
               "Diesel,R22\n")
    df = readers.read_csv(spark, p, schemas.POLICY_CLAIMS)
    cast = readers.cast_columns(df.drop("IDpol"), schemas.CLAIM_NUMERIC)
    assert dict(cast.dtypes)["ClaimNb"] == "double" and dict(cast.dtypes)["Area"] == "string"
    rows = cast.collect()
    assert rows[0].ClaimNb == 0.0 and rows[1].ClaimNb is None


def test_csv_without_header_renamed_by_position(spark):
    line = ",".join(["1"] + [str(i / 10) for i in range(28)])
    p = _write(line + "\n" + line.replace("1,", "0,", 1) + "\n")
    df = readers.read_csv(spark, p, schemas.COLLISION_EVENTS, header=False)
    named = readers.rename_by_position(df, schemas.COLLISION_COLUMNS)
    typed = readers.cast_columns(named, schemas.COLLISION_COLUMNS)
    assert typed.columns[0] == "label" and typed.columns[-1] == "m_wwbb"
    assert {t for _, t in typed.dtypes} == {"double"}
    assert sorted(r.label for r in typed.collect()) == [0.0, 1.0]


def test_corrupt_records_are_kept(spark):
    p = _write('movieId,title,genres\n1,Toy Story,A|B\n2,"broken\n')
    df = readers.read_csv(spark, p, schemas.MOVIES, keep_corrupt=True)
    assert df.count() >= 2


def test_result_sink_and_preview(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quarry-out-"), "t")
    df = spark.range(10).withColumnRenamed("id", "k")
    sinks.write_result(df, out)
    back = spark.read.parquet(out)
    assert back.count() == 10
    assert [r.k for r in sinks.preview(back, 3, ["k"]).collect()] == [0, 1, 2]
    with sinks.persisted(back) as b:
        assert b.is_cached
    assert not back.is_cached
