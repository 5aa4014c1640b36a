"""URL filters: a trie over reversed host labels and path segments.

A rule is a host and a path. It fits a url whose host is the rule's or a subdomain of it and
whose path starts with the rule's; the longest rule that fits decides (more host labels first,
then the longer path). Rules are compiled to one trie of nested dictionaries: host labels from
the last to the first, then whole path segments; what follows the last ``/`` of a rule's path
is a beginning of a segment and is kept at its node by length.

The trie is broadcast: its size is that of the rule list, which doesn't grow with the pages and
is checked against a bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

MAX_BROADCAST_RULES = 2_000_000
PATH, STARTS = "\0path", "\0starts"

Rule = tuple[str, str, str]
Node = dict


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = rest[:end], rest[end:]
    end = next((i for i, c in enumerate(rest) if c in "?#"), len(rest))
    return host.translate(LOWER), rest[:end]


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def build(rules: Iterable[Rule]) -> Node:
    """Trie of (verdict, host, path); of equal host and path the last one holds."""
    root: Node = {}
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.translate(LOWER).split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(PATH, {})
        *whole, start = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        node.setdefault(STARTS, {}).setdefault(len(start), {})[start] = (host + path, verdict)
    return root


def _longest_path(node: Node, path: str) -> tuple[str, str] | None:
    found = None
    segments = path.split("/")
    for i, segment in enumerate(segments):
        starts = node.get(STARTS, {})
        for size in sorted(starts, reverse=True):
            # a beginning without "/" lies in this segment, else it would be a whole one
            hit = starts[size].get(segment[:size]) if len(segment) >= size else None
            if hit:
                found = hit
                break
        if i + 1 == len(segments) or segment not in node:
            break
        node = node[segment]
    return found


def longest(root: Node, host: str, path: str) -> tuple[str, str] | None:
    """Rule (host and path) and verdict of the longest rule that fits."""
    node, found = root, None
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        if PATH in node:
            found = _longest_path(node[PATH], path) or found
    return found


def _judge(trie, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = trie.value
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for url in batch.column(1).to_pylist():
                host, path = parts(url)
                rule, verdict = longest(root, host, path) or (None, default)
                for column, value in zip(out, (host, path, rule, verdict)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=pa.string()) for c in out)],
                names=["row", "host", "path", "rule", "verdict"],
            )

    return run


def filter_urls(
    pages: DataFrame, rules: Iterable[Rule], url_column: str = "url", default: str = "allow"
) -> DataFrame:
    """``row`` (struct of the input's columns), host, path, rule (null if none fits) and
    verdict (``default`` if none fits).

    A null url and one without ``://`` have an empty host and path; a rule fits neither unless
    it is empty itself. Each row is judged by itself, so repeated rows, rows without id and
    very long urls need nothing more; no rows give none.
    """
    rules = list(rules)
    if len(rules) > MAX_BROADCAST_RULES:
        raise ValueError(f"{len(rules)} rules; a trie of up to {MAX_BROADCAST_RULES} is broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(build(rules))
    rows = pages.select(
        F.struct(*(pages[c] for c in pages.columns)).alias("row"),
        pages[url_column].cast("string").alias("url"),
    )
    schema = T.StructType([rows.schema["row"]])
    for name in ("host", "path", "rule", "verdict"):
        schema = schema.add(name, "string")
    return rows.mapInArrow(_judge(trie, default), schema)
