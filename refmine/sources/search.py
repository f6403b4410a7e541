"""Paper search: a local provider over the paper table, and a paged REST source."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the service's paging.
PAGE, ATTEMPTS, RETRY_S, PAUSE_S, TIMEOUT_S = 100, 10, 5.0, 1.0, 30.0
FIELDS = ("corpusId", "title", "abstract")
KEY_VARIABLE = "SEMANTIC_SCHOLAR_API_KEY"
SEARCH_URL = "https://api.semanticscholar.org/graph/v1/paper/search"


def search_local(papers: DataFrame, query: str, limit: int | None = None, offset: int = 0, fields_of_study: Sequence[str] | None = None) -> DataFrame:
    """Papers whose title or abstract holds every word of the query, by corpusid; zero and null ids are left out."""
    text = F.lower(F.concat_ws(" ", "title", "abstract"))
    found = papers.where("corpusid <> 0")
    for word in query.lower().split():
        found = found.where(F.contains(text, F.lit(word)))
    if fields_of_study:
        found = found.where(F.arrays_overlap("fields_of_study", F.array(*[F.lit(f) for f in fields_of_study])))
    if limit is not None:
        found = found.orderBy("corpusid").offset(offset).limit(limit)
    return found


def paper_by_id(papers: DataFrame, corpusid: int, fields: Sequence[str] = ("corpusid", "title", "abstract")) -> DataFrame:
    """The paper's row, or none."""
    return papers.where(F.col("corpusid") == corpusid).select(*fields)


def http_get(url: str, params: dict, headers: dict) -> tuple[int, dict]:
    """(status, body) of one request; the library is imported where it is used."""
    import requests

    r = requests.get(url, params=params, headers=headers, timeout=TIMEOUT_S)
    return r.status_code, r.json() if r.status_code == 200 else {}


def fetch_page(url: str, query: str, limit: int, offset: int, get: Callable = http_get, sleep: Callable = time.sleep, fields: Sequence[str] = FIELDS, fields_of_study: Sequence[str] | None = None, api_key: str = "") -> tuple[list[dict], int]:
    """(papers, total) of one page; busy answers and failures are tried again, and raise in the end."""
    params = {"query": query, "limit": limit, "offset": offset, "fields": ",".join(fields)}
    if fields_of_study:
        params["fieldsOfStudy"] = ",".join(fields_of_study)
    trouble: object = None
    for attempt in range(ATTEMPTS):
        if attempt:
            sleep(RETRY_S)
        try:
            status, body = get(url, params, {"x-api-key": api_key} if api_key else {})
            if status == 200:
                return body.get("data") or [], int(body.get("total") or 0)
            trouble = f"status {status}"
        except Exception as e:  # noqa: BLE001 - a failed request is tried again
            trouble = e
    raise ConnectionError(f"no page at offset {offset} after {ATTEMPTS} attempts: {trouble}")


class _Pages(InputPartition):
    def __init__(self, offset: int, limit: int):
        self.offset, self.limit = offset, limit


class _Reader(DataSourceReader):
    def __init__(self, options: dict, get: Callable):
        self.o, self.get = options, get

    def partitions(self) -> list[InputPartition]:
        # One partition: the service wants a second between pages.
        return [_Pages(int(self.o.get("offset", 0)), int(self.o.get("limit", 100)))]

    def read(self, p: _Pages) -> Iterator[tuple]:
        pause = float(self.o.get("pause", PAUSE_S))
        study = self.o.get("fields_of_study")
        done, total = 0, None
        while done < p.limit and (total is None or p.offset + done < total):
            size = min(PAGE, p.limit - done)
            if total is not None and pause:
                time.sleep(pause)
            rows, of = fetch_page(self.o["url"], self.o["query"], size, p.offset + done, self.get, fields_of_study=study.split(",") if study else None, api_key=self.o.get("api_key") or os.getenv(KEY_VARIABLE, ""))
            total = of if total is None else total
            for r in rows:
                yield (int(r["corpusId"]) if r.get("corpusId") else None, r.get("title"), r.get("abstract"))
            done += size


class PaperSearchSource(DataSource):
    """``spark.read.format("paper_search").option("url", ...).option("query", ...).option("limit", ...)``."""

    getter: Callable = staticmethod(http_get)

    @classmethod
    def name(cls) -> str:
        return "paper_search"

    def schema(self) -> str:
        return "corpusid bigint, title string, abstract string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), type(self).getter)
