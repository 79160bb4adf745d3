import os

import pytest

from conftest import local_path
from tablewright.errors import CapabilityError
from tablewright.plans import jobs
from tablewright.session import has_avro
from tablewright.sinks.avro import write_avro
from tablewright.sources.avro import read_avro, spark_type

SCHEMA_JSON = ('{"type":"record","name":"episode","fields":['
               '{"name":"title","type":"string"},{"name":"air_date","type":["null","string"]},'
               '{"name":"doctor","type":"int"}]}')


def _write_avro_fixture(spark, path, rows):
    """A small .avro file written by Avro's own Java writer (fixture only)."""
    jvm = spark.sparkContext._jvm
    os.makedirs(os.path.dirname(path), exist_ok=True)
    schema = getattr(jvm.org.apache.avro, "Schema$Parser")().parse(SCHEMA_JSON)
    writer = jvm.org.apache.avro.file.DataFileWriter(jvm.org.apache.avro.generic.GenericDatumWriter(schema))
    writer.create(schema, jvm.java.io.File(path))
    for title, air, doctor in rows:
        rec = getattr(jvm.org.apache.avro.generic, "GenericData$Record")(schema)
        rec.put("title", title)
        rec.put("air_date", air)
        rec.put("doctor", doctor)
        writer.append(rec)
    writer.close()


ROWS = [("The Eleventh Hour", "3 April 2010", 11), ("The Doctor's Wife", None, 11),
        ("Horror of Fang Rock", "3 September 1977", 4), ("An Unearthly Child", "23 November 1963", 1)]


def test_read_avro_and_filter(spark, workdir):
    d = local_path(workdir)
    _write_avro_fixture(spark, f"{d}/avro/episodes.avro", ROWS)
    df = read_avro(spark, f"{workdir}/avro", "title string, air_date string, doctor int")
    assert sorted(tuple(r) for r in df.collect()) == sorted(ROWS)
    subset = df.where("doctor > 5")
    assert sorted(r["title"] for r in subset.collect()) == ["The Doctor's Wife", "The Eleventh Hour"]
    inferred = read_avro(spark, f"{workdir}/avro")
    assert inferred.dtypes == [("title", "string"), ("air_date", "string"), ("doctor", "int")]
    assert sorted(tuple(r) for r in inferred.collect()) == sorted(ROWS)


def test_writer_schema_gives_order_and_types():
    fields = [{"name": "z", "type": "int"}, {"name": "a", "type": ["null", "float"]},
              {"name": "l", "type": {"type": "array", "items": "long"}},
              {"name": "e", "type": {"type": "enum", "name": "x", "symbols": ["P"]}},
              {"name": "m", "type": {"type": "map", "values": "boolean"}}]
    got = spark_type({"type": "record", "name": "r", "fields": fields})
    assert got.simpleString() == "struct<z:int,a:float,l:array<bigint>,e:string,m:map<string,boolean>>"


@pytest.mark.parametrize("kind", [
    {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}, "bytes", ["int", "string"],
    {"type": "long", "logicalType": "timestamp-micros"}, {"type": "fixed", "name": "f", "size": 4}])
def test_types_that_text_cannot_carry_are_refused(kind):
    with pytest.raises(CapabilityError, match="record.m: .*spark-avro"):
        spark_type({"type": "record", "name": "r", "fields": [{"name": "m", "type": kind}]})


def test_avro_write_without_module_fails_loudly(spark, workdir):
    if has_avro(spark):
        pytest.skip("spark-avro is on the classpath")
    with pytest.raises(CapabilityError, match="spark-avro"):
        write_avro(spark.range(3), f"{workdir}/out")
    d = local_path(workdir)
    _write_avro_fixture(spark, f"{d}/src/e.avro", ROWS)
    with pytest.raises(CapabilityError):
        jobs.avro_subset_copy(spark, f"{workdir}/src", f"{workdir}/dst",
                              schema="title string, air_date string, doctor int")
    assert not os.path.exists(f"{d}/dst")
