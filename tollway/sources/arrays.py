"""Small tables in the formats of desktop tools: NumPy match arrays and spreadsheets. Both hold one row per checkpoint, hour
or bin, and go through the driver; larger tables are refused."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tollway.sources.tables import head_bytes

#: Rows and bytes that pass through the driver at most.
ROWS, BYTES = 1_000_000, 256 << 20


def _rows(df: DataFrame, most: int) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write Parquet instead")
    return rows


def read_match_npy(spark: SparkSession, path: str) -> DataFrame:
    """(seq, node, KKBH, dist_m) of an array of three rows: nodes, checkpoints, distances. Pickled objects are not read."""
    data = np.load(io.BytesIO(head_bytes(spark, path, BYTES)), allow_pickle=False)
    if data.ndim != 2 or len(data) < 2:
        raise ValueError(f"{path}: rows of nodes and checkpoints are expected")
    dist = [float(x) for x in data[2]] if len(data) > 2 else [None] * data.shape[1]
    rows = [(i, str(n), str(k), d) for i, (n, k, d) in enumerate(zip(data[0], data[1], dist, strict=True))]
    return spark.createDataFrame(rows, "seq long, node string, KKBH string, dist_m double")


def write_match_npy(matched: DataFrame, path: str) -> None:
    rows = _rows(matched.select("node", "KKBH", "dist_m", "seq").orderBy("seq"), ROWS)
    np.save(path, np.array([[r[0] for r in rows], [r[1] for r in rows], [str(r[2]) for r in rows]], dtype=np.str_))


def read_positions_npy(spark: SparkSession, path: str) -> DataFrame:
    """(name, lon, lat) of an array of names and one of coordinates in an .npz file."""
    data = np.load(io.BytesIO(head_bytes(spark, path, BYTES)), allow_pickle=False)
    rows = [(str(n), float(x), float(y)) for n, (x, y) in zip(data["name"], data["xy"], strict=True)]
    return spark.createDataFrame(rows, "name string, lon double, lat double")


def write_positions_npy(nodes: DataFrame, path: str) -> None:
    rows = _rows(nodes.select("name", "lon", "lat"), ROWS)
    np.savez(path, name=np.array([r[0] for r in rows], dtype=np.str_), xy=np.array([r[1:] for r in rows], dtype=float).reshape(-1, 2))


COLUMNS = ("kkod", "period", "min", "median", "max")


def write_thresholds_npy(rows: DataFrame, path: str) -> None:
    """Rows of pair, period, min, median and max, as text."""
    found = _rows(rows.select(*COLUMNS), ROWS)
    np.save(path, np.array([["nan" if v is None else str(v) for v in r] for r in found], dtype=np.str_).reshape(-1, len(COLUMNS)))


def read_thresholds_npy(spark: SparkSession, path: str) -> DataFrame:
    """(from_KKBH, to_KKBH, kkod, period, min, median, max) of an array of five columns. Pickled objects are not read."""
    data = np.load(io.BytesIO(head_bytes(spark, path, BYTES)), allow_pickle=False)
    if data.ndim != 2 or data.shape[1] != len(COLUMNS):
        raise ValueError(f"{path}: rows of {', '.join(COLUMNS)} are expected")
    rows = [(*str(k).split("-", 1), str(k), str(p), *map(float, x)) for k, p, *x in data]
    return spark.createDataFrame(rows, "from_KKBH string, to_KKBH string, kkod string, period string, min double, median double, max double")


def write_xlsx(df: DataFrame, path: str, most: int = 100_000) -> None:
    """One sheet with a header; numbers as numbers, all else as text."""

    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v!r}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    rows = [df.columns, *_rows(df, most)]
    sheet = "".join(f"<row>{''.join(cell(v) for v in r)}</row>" for r in rows)
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>',
    }
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n' + text)
