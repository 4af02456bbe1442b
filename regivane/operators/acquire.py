"""The relational side of acquisition: request grid, pending months, payloads, pages to rows."""

from __future__ import annotations

import contextlib
import json
import time
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regivane import schemas as S
from regivane.functions import text
from regivane.operators import markup

# The request's fields that never change, with their values.
PAYLOAD_CONSTANTS = {
    "subtitulo": "POR MUNICIPIO", "idMunicipio": "0", "mostrarFechaNula": "0", "idColonia": "0", "idNacionalidad": "0",
    "edadInicio": "", "edadFin": "", "mostrarEdadNula": "0", "idHipotesis": "", "idMedioConocimiento": "", "idCircunstancia": "",
    "tieneDiscapacidad": "", "idTipoDiscapacidad": "0", "idEtnia": "0", "idLengua": "0", "idReligion": "", "esMigrante": "",
    "idEstatusMigratorio": "0", "esLgbttti": "", "esServidorPublico": "", "esDefensorDH": "", "esPeriodista": "",
    "esSindicalista": "", "esONG": "", "idHipotesisNoLocalizacion": "0", "idDelito": "0",
}
PAYLOAD_KIND = 3


def request_grid(spark: SparkSession, statuses: list[int] | None = None, years: list[int] | None = None, months: list[int] | None = None) -> DataFrame:
    """Every status, year, month and state to ask for, with the month's first and last day.

    The grid comes from the parameters alone, so its size does not depend on any data.
    """
    statuses = list(S.STATUSES) if statuses is None else statuses
    years = list(range(S.YEARS[0], S.YEARS[1] + 1)) if years is None else years
    months = list(range(S.MONTHS[0], S.MONTHS[1] + 1)) if months is None else months
    lists = {"status_id": statuses, "year": years, "month": months, "id_estado": list(range(1, len(S.STATES) + 1))}
    grid = spark.range(1).select()
    for name, values in lists.items():
        grid = grid.withColumn(name, F.explode(F.array(*(F.lit(v).cast("bigint") for v in values)).cast("array<bigint>")))
    y, m = F.col("year").cast("int"), F.col("month").cast("int")
    return grid.withColumns({"date_start": text.first_of_month(y, m), "date_end": text.last_of_month(y, m)})


def pending_months(grid: DataFrame, present: DataFrame) -> DataFrame:
    """Months of the grid that are not yet there; ``present`` is (status_id, year, month)."""
    return grid.select("status_id", "year", "month").distinct().join(present, ["status_id", "year", "month"], "left_anti")


def payloads(grid: DataFrame) -> DataFrame:
    """Add ``payload``, the JSON body of each request."""
    titles = F.create_map(*(F.lit(v) for k, (_, title) in S.STATUSES.items() for v in (k, title)))
    fields = {
        "titulo": F.coalesce(F.element_at(titles, F.col("status_id").cast("int")), F.lit("TEST")),
        "idEstatusVictima": F.col("status_id").cast("string"),
        "fechaInicio": F.col("date_start"),
        "fechaFin": F.col("date_end"),
        "idEstado": F.col("id_estado").cast("string"),
        **{k: F.lit(v) for k, v in PAYLOAD_CONSTANTS.items()},
        "TipoDetalle": F.lit(PAYLOAD_KIND),
    }
    return grid.withColumn("payload", F.to_json(F.struct(*(v.alias(k) for k, v in fields.items()))))


def page_html(body) -> F.Column:
    """The markup in a JSON response; null where there is none or the response is no JSON."""
    html = F.get_json_object(body, "$.Html")
    return F.when(html != "", html)


def _records(cells: DataFrame, meta: list[str]) -> DataFrame:
    """Typed records from (municipio, c1, c2, c3): numbers parsed leniently, rows of zeros left out."""
    counted = cells.withColumns({"hombres": text.to_int(F.col("c1")), "mujeres": text.to_int(F.col("c2")), "indeterminado": text.to_int(F.col("c3"))})
    counted = counted.where("hombres != 0 OR mujeres != 0 OR indeterminado != 0")
    return counted.select(*meta, "municipio", "hombres", "mujeres", "indeterminado", (F.col("hombres") + F.col("mujeres") + F.col("indeterminado")).alias("total_personas"))


def extract_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Records of pages of any quality, in the JVM; see :mod:`regivane.operators.markup`.

    A page with a count in digits that are no decimal ones (superscripts) cannot be read and gives
    no rows.
    """
    meta = [c for c in pages.columns if c != html]
    rows = markup.row_cells(F.col(html))
    bad = F.exists(rows, lambda r: F.exists(F.slice(r, 2, 3), text.is_odd_int))
    found = pages.select(*meta, F.explode(F.when(~bad, rows)).alias("td"))
    return _records(found.select(*meta, F.col("td")[0].alias("municipio"), *(F.col("td")[k].alias(f"c{k}") for k in (1, 2, 3))), meta)


class _Table(HTMLParser):
    """Cells of every row, tags closed or not; a nested row's cells count for the outer rows too."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list[str]]] = []
        self.open_rows: list[list[list[str]]] = []
        self.cell: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            row: list[list[str]] = []
            self.rows.append(row)
            self.open_rows.append(row)
        elif tag == "td" and self.open_rows:
            cell: list[str] = []
            for row in self.open_rows:
                row.append(cell)
            self.cell.append(cell)

    def handle_endtag(self, tag):
        if tag == "tr" and self.open_rows:
            self.open_rows.pop()
        elif tag == "td" and self.cell:
            self.cell.pop()

    def handle_data(self, data):
        for cell in self.cell:
            cell.append(data)


def table_rows(html: str | None) -> Iterator[tuple[str, str, str, str]]:
    """Name and three cells of the rows of a page of any quality; a page that cannot be parsed gives none."""
    parser = _Table()
    try:
        parser.feed(html or "")
        parser.close()
    except (ValueError, AssertionError):
        return
    for row in parser.rows:
        if len(row) >= 4:
            yield "".join(t.strip() for t in row[0]), "".join(row[1]), "".join(row[2]), "".join(row[3])


def extract_rows_tolerant(pages: DataFrame, html: str = "html") -> DataFrame:
    """As :func:`extract_rows` through the standard library's parser; cells of a row without an end tag end with the page."""
    meta = [c for c in pages.columns if c != html]
    cells = ["municipio", "c1", "c2", "c3"]
    schema = T.StructType([*(pages.schema[c] for c in meta), *(T.StructField(c, T.StringType()) for c in cells)])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows = list(table_rows(batch.column(len(meta))[at].as_py()))
                if rows:
                    page = pa.array([at] * len(rows), pa.int32())
                    columns = [batch.column(k).take(page) for k in range(len(meta))]
                    yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.string()) for c in zip(*rows, strict=True))], [*meta, *cells])

    return _records(pages.select(*meta, html).mapInArrow(parsed, schema), meta)


def with_dimensions(records: DataFrame, id_column: str = "id_estado") -> DataFrame:
    """Add the state's name; the empty text for an unknown id."""
    names = F.create_map(*(F.lit(v) for k, n in enumerate(S.STATES, start=1) for v in (k, n)))
    return records.withColumn("estado", F.coalesce(F.try_element_at(names, F.col(id_column).cast("int")), F.lit("")))


def union_months(frames: list[DataFrame]) -> DataFrame:
    """Monthly tables one below the other, by column name; a column that one lacks is null there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def records_from_responses(responses: DataFrame, tolerant: bool = False) -> DataFrame:
    """Raw records of (status_id, year, month, id_estado, http_status, body).

    A response that failed, is empty, is no JSON or has no markup contributes nothing.
    """
    html = F.when((F.col("http_status") == 200) & (F.length("body") > 0), page_html(F.col("body")))
    pages = responses.select("status_id", "year", "month", "id_estado", html.alias("html")).where("html IS NOT NULL")
    rows = with_dimensions((extract_rows_tolerant if tolerant else extract_rows)(pages))
    named = rows.select("*", F.col("year").alias("anio"), F.col("month").alias("mes"), F.col("status_id").alias("id_estatus_victima"))
    return named.select(*(F.col(f.name).cast(f.dataType) for f in S.RAW_SCHEMA))


def fetch(requests: DataFrame, send: Callable[[str], tuple[int, str]], attempts: int = 4, pause: float = 0.5, factor: float = 1.5) -> DataFrame:
    """Add ``http_status`` and ``body`` to rows with a ``payload``, by ``send(payload)``.

    A request that raises an OSError, or whose answer is not a 200 with a ``Html`` field, is
    sent again after a growing pause; after the last attempt its last answer stays (null where
    there was none).  A row that is computed again is sent again.
    """
    schema = T.StructType([*requests.schema.fields, T.StructField("http_status", T.IntegerType()), T.StructField("body", T.StringType())])

    def good(status: int | None, body: str | None) -> bool:
        try:
            return status == 200 and bool(body) and bool(json.loads(body).get("Html"))
        except (ValueError, AttributeError):
            return False

    def ask(payload: str) -> tuple[int | None, str | None]:
        status, body, wait = None, None, pause
        for attempt in range(attempts):
            with contextlib.suppress(OSError):
                status, body = send(payload)
                if good(status, body):
                    break
            if attempt + 1 < attempts:
                time.sleep(wait)
                wait *= factor
        return status, body

    def fetched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [ask(p) for p in frame["payload"]]
            yield frame.assign(http_status=pd.array([a for a, _ in answers], dtype="Int32"), body=[b for _, b in answers])

    return requests.mapInPandas(fetched, schema)
