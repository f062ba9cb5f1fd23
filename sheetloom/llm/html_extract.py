"""HTML extraction by wrappers that are inferred for each host."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.wrapper import Node, align, folded, main_texts, parse, shape
from sheetloom.sources.staging import stage

#: Hosts whose wrappers a task holds at once while it reads pages.
HOSTS = 2000
#: Parts that a host's partial wrappers are merged in first.
PARTS = 16
SCHEMA = "host string, part int, wrapper string"


def _row(host: str, part: int, wrapper: Node) -> tuple[str, int, str]:
    return host, part, json.dumps(wrapper.pack(), separators=(",", ":"))


def _batch(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    hosts, parts, wrappers = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array(parts, pa.int32()), pa.array(wrappers, pa.string())],
        names=["host", "part", "wrapper"],
    )


def _join(old: Node | None, new: Node) -> Node:
    return new if old is None else align([old], [new])[0]


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages -> a wrapper for each host of the partition."""
    from pyspark import TaskContext

    part, hosts = TaskContext.get().partitionId() % PARTS, {}
    for batch in batches:
        for host, page in zip(batch["host"].to_pylist(), batch["html"]):
            found, _ = parse(page.as_py() or "")
            hosts[host] = _join(hosts.get(host), folded(found))
            if len(hosts) > HOSTS:
                yield _batch([_row(h, part, w) for h, w in hosts.items()])
                hosts = {}
    yield _batch([_row(h, part, w) for h, w in hosts.items()])


def _combine(final: bool):
    """Wrappers sorted by host and part -> one for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, wrapper = None, None

        for batch in batches:
            for host, part, packed in zip(batch["host"].to_pylist(), batch["part"].to_pylist(), batch["wrapper"]):
                own = (host, 0 if final else part)
                if wrapper is not None and own != key:
                    yield _batch([_row(*key, wrapper)])
                    wrapper = None
                key, wrapper = own, _join(wrapper, Node.unpack(json.loads(packed.as_py())))
        if wrapper is not None:
            yield _batch([_row(*key, wrapper)])

    return run


def _with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )


def infer_wrappers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, wrapper``: what all pages of a host have in common.

    Each partition aligns the pages of its hosts as it reads them; only partial
    wrappers, one for each host and partition, are shuffled, and those of a host are
    merged in parts first.  A host with a third of all pages costs as much as many
    small ones.
    """
    partial = _with_host(pages, id_col, url_col, html_col).select("host", "html").mapInArrow(_infer, SCHEMA)
    parts = partial.repartition("host", "part").sortWithinPartitions("host", "part", "wrapper").mapInArrow(_combine(False), SCHEMA)
    whole = parts.repartition("host").sortWithinPartitions("host", "part").mapInArrow(_combine(True), SCHEMA)
    return stage(whole.select("host", "wrapper"), "wrappers")


def _extract():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], list[int]] = {}
        wrappers: dict[str, list] = {}
        for batch in batches:
            out = []
            # A host's wrapper is one text for all its pages of a batch.
            column = batch["wrapper"].dictionary_encode()
            own = column.dictionary.to_pylist()
            for page, number in zip(batch["html"], column.indices.to_pylist()):
                packed = own[number]
                found, texts = parse(page.as_py())
                key = (packed, shape(found))
                if key not in known:
                    if len(known) > 20_000:
                        known.clear()
                        wrappers.clear()
                    if packed not in wrappers:
                        wrappers[packed] = json.loads(packed)
                    known[key] = main_texts(Node.unpack(wrappers[packed]), found)
                out.append("\n".join(texts[i] for i in known[key]))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["url"], pa.array(out, pa.string())], names=["id", "url", "text"])

    return run


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per input row: ``id_col, url_col, text``, the main text of the page.

    Pages of a host are aligned into a wrapper, a union-free regular expression over
    nested tags with optional and repeated groups and text slots.  Each page is aligned
    with its host's wrapper; which slots are main text (see ``assign_roles``) follows from
    what varies across the host's pages and from what elements are called, among those
    that the page itself has, as a host may have several templates.
    It gives the texts of the main slots, one line per block, character references
    decoded and white space made single spaces.

    Null and empty pages have no text.  Pages without a host are one host.  Repeated
    rows give equal results; extra columns are ignored; an empty table gives an empty
    result.
    """
    rows = _with_host(pages, id_col, url_col, html_col)
    wrappers = infer_wrappers(pages, id_col, url_col, html_col).withColumnRenamed("host", "of_host")
    id_type = rows.schema["id"].dataType.simpleString()
    return (
        rows.join(wrappers, F.col("host") == F.col("of_host"))
        .select("id", "url", "html", "wrapper")
        .mapInArrow(_extract(), f"id {id_type}, url string, text string")
        .withColumnsRenamed({"id": id_col, "url": url_col})
    )
