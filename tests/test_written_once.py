"""What large tables are written as."""

from pathlib import Path

import pyarrow.parquet as pq

from tests.conftest import SMALL
from tidepool.plans import registry
from tidepool.sources import fixtures as X
from tidepool.sources import io as IO


def test_table_and_csv_are_written_compressed(spark):
    registry.load_all()
    found = registry.QUERIES["scan_observations_csv"](spark, SMALL)
    table = X.labelled_base(spark, SMALL)
    assert found.count() == table.count() > 0
    folder = Path(IO.shared_root(spark).removeprefix("file:"))
    assert all(p.name.endswith(".csv.gz") for p in max((folder / "observations-csv").iterdir(), key=lambda p: p.stat().st_mtime).glob("part-*"))
    file = next(Path(p.removeprefix("file:")) for p in table.inputFiles())
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
