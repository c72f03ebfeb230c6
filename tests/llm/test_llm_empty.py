"""Every query of the subpackage runs on empty tables and on tables of nulls."""

from pathlib import Path

import pytest

from paperloom.llm.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
TABLES = "files extracted forms items document_templates type_phrases classifications vocabulary_gap documents reading_labels source_targets".split()


@pytest.fixture(scope="module")
def bare(tmp_path_factory):
    """Two folders: tables without rows, and tables of a few rows without values but for keys."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    empty, nulls = tmp_path_factory.mktemp("empty"), tmp_path_factory.mktemp("nulls")
    for name in TABLES:
        schema = pq.read_schema(FOLDER / f"{name}.parquet").remove_metadata()
        pq.write_table(schema.empty_table(), empty / f"{name}.parquet")
        keys = {"resultid", "extractid", "formkey", "gapid", "doc_id"}
        columns = [pa.array(range(3), f.type) if f.name in keys else pa.nulls(3, f.type) for f in schema]
        pq.write_table(pa.Table.from_arrays(columns, schema=schema), nulls / f"{name}.parquet")
    return {"empty": str(empty), "nulls": str(nulls)}


@pytest.mark.parametrize("kind", ["empty", "nulls"])
def test_all_queries(spark, bare, kind):
    failed = {}
    for name, f in QUERIES.items():
        try:
            f(spark, bare[kind]).collect()
        except Exception as x:  # noqa: BLE001
            failed[name] = str(x)[:300]
    assert not failed
