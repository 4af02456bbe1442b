"""Responses as a table: a Python data source that asks for the months that a query wants.

Filters on status, year and month are pushed into the source, which makes a partition of each month
of each status that they leave and that is not there yet.  A task asks for its month, state by state,
and asks again after failures.  Sessions need ``spark.sql.python.filterPushdown.enabled``; without it
Spark asks for all months and filters afterwards, with the same rows.
"""

from __future__ import annotations

import calendar
import contextlib
import json
import os
import re
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from regivane import schemas as S
from regivane.operators.acquire import PAYLOAD_CONSTANTS, PAYLOAD_KIND
from regivane.sources.months import mounted

FORMAT = "regivane_responses"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_SCHEMA = "status_id bigint, year bigint, month bigint, id_estado bigint, http_status int, body string, attempts int"
_COMPARED = {EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}

#: Answers one request, a JSON payload, with a status and a body; an OSError is a request that failed.
Sender = Callable[[str], tuple[int, str]]


def payload_of(status_id: int, year: int, month: int, id_estado: int) -> str:
    """The JSON body of a request, as :func:`regivane.operators.acquire.payloads` has it."""
    last = calendar.monthrange(year, month)[1]
    fields = {"titulo": S.STATUSES[status_id][1] if status_id in S.STATUSES else "TEST", "idEstatusVictima": str(status_id), "fechaInicio": f"{year}-{month:02d}-01", "fechaFin": f"{year}-{month:02d}-{last:02d}", "idEstado": str(id_estado)}
    return json.dumps(fields | PAYLOAD_CONSTANTS | {"TipoDetalle": PAYLOAD_KIND}, ensure_ascii=False, separators=(",", ":"))


def is_answer(status: int | None, body: str | None) -> bool:
    """Whether a response is a 200 with markup."""
    try:
        return status == 200 and bool(body) and bool(json.loads(body).get("Html"))
    except (ValueError, AttributeError):
        return False


def ask(send: Sender, payload: str, attempts: int, pause: float, factor: float) -> tuple[int | None, str | None, int]:
    """The last answer to a request that is sent until it is answered, and how often it was sent."""
    status, body = None, None
    for attempt in range(1, attempts + 1):
        with contextlib.suppress(OSError):
            status, body = send(payload)
            if is_answer(status, body):
                break
        if attempt < attempts:
            time.sleep(pause)
            pause *= factor
    return status, body, attempt


@dataclass
class Month(InputPartition):
    status_id: int
    year: int
    month: int


class ResponseReader(DataSourceReader):
    def __init__(self, source: type[ResponseSource]):
        self.source, self.filters = source, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take the filters that tell months apart; the others stay with Spark."""
        for f in filters:
            if type(f) in _COMPARED and f.attribute in (("status_id",), ("year",), ("month",)):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        present = set(self.source.present)
        months = [Month(s, y, m) for s in self.source.statuses for y in self.source.years for m in self.source.months if (s, y, m) not in present]
        return [p for p in months if all(_COMPARED[type(f)](getattr(p, f.attribute[0]), f.value) for f in self.filters)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not isinstance(partition, Month):  # no month is left
            return
        send = self.source.connect()
        for id_estado in range(1, len(S.STATES) + 1):
            payload = payload_of(partition.status_id, partition.year, partition.month, id_estado)
            yield (partition.status_id, partition.year, partition.month, id_estado, *ask(send, payload, self.source.attempts, self.source.pause, self.source.factor))


class ResponseSource(DataSource):
    """Subclasses name the service; :func:`responses` makes one."""

    connect: Callable[[], Sender]
    present: list[tuple[int, int, int]] = []
    statuses = list(S.STATUSES)
    years = list(range(S.YEARS[0], S.YEARS[1] + 1))
    months = list(range(S.MONTHS[0], S.MONTHS[1] + 1))
    attempts, pause, factor = 4, 0.5, 1.5

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> ResponseReader:
        return ResponseReader(type(self))


def responses(spark: SparkSession, connect: Callable[[], Sender], present: DataFrame | None = None, **settings) -> DataFrame:
    """(status_id, year, month, id_estado, http_status, body, attempts) of the months that are not ``present``.

    ``connect`` gives each task its sender; ``settings`` override the source's years, attempts and so on.
    A task that is run again asks again.
    """
    there = [] if present is None else [tuple(r) for r in present.select("status_id", "year", "month").distinct().collect()]  # months, not rows
    source = type("Responses", (ResponseSource,), {"connect": staticmethod(connect), "present": there, **settings})
    spark.dataSource.register(source)
    return spark.read.format(FORMAT).load()


class StoredResponses:
    """A service that answers from files: a folder for each status, year and month, in it lines (id_estado, answers).

    ``answers`` are given in their order, the last one from then on; without any, a 404.
    """

    def __init__(self, folder: str):
        self.folder, self.month, self.held, self.sent = mounted(folder), None, {}, {}

    def __call__(self, payload: str) -> tuple[int, str]:
        fields = json.loads(payload)
        year, month = re.match("([0-9]+)-([0-9]+)", fields["fechaInicio"]).groups()
        wanted = f"status_id={fields['idEstatusVictima']}/year={int(year)}/month={int(month)}"
        if wanted != self.month:
            self.month, self.held, self.sent = wanted, self._read(os.path.join(self.folder, wanted)), {}
        answers = self.held.get(fields["idEstado"]) or [{"status": 404, "body": ""}]
        at = self.sent[payload] = self.sent.get(payload, -1) + 1
        answer = answers[min(at, len(answers) - 1)]
        if answer["status"] == 0:
            raise OSError("no connection")
        return answer["status"], answer["body"]

    @staticmethod
    def _read(folder: str) -> dict[str, list]:
        out = {}
        for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
            if name.startswith("part-"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    out |= {str(row["id_estado"]): row["answers"] for row in map(json.loads, f)}
        return out
