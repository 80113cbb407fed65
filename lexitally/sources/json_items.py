"""JSON objects of any size as rows: a file is read from front to back, and every scalar in it is a
row as soon as it has been read. Nothing but the way down to it is held."""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator
from functools import partial

from pyspark.sql import DataFrame

from ..session import ship
from .files import _opened

BLOCK = 1 << 20  # characters read on at once
_ROWS = 8192     # items sent on at once

ITEMS = "file STRING, at BIGINT, path ARRAY<STRING>, kind STRING, value STRING"

# The tokens of JSON.
_STRING = r'"[^"\\\x00-\x1f]*(?:\\.[^"\\\x00-\x1f]*)*"'
_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
_TOKEN = re.compile(rf"[ \t\r\n]*(?:([{{}}\[\],:])|({_STRING})|({_NUMBER})(?=[ \t\r\n,\]}}])|(true|false|null)(?=[ \t\r\n,\]}}]))")
# A whole member of an object, up to the next one: most of a file of counts.
_MEMBER = re.compile(rf"[ \t\r\n]*({_STRING})[ \t\r\n]*:[ \t\r\n]*({_NUMBER})[ \t\r\n]*,")


def _text(token: str) -> str:
    return json.loads(token) if "\\" in token else token[1:-1]


class Reader:
    """Scalars of one document: (path, kind, value), in the order of the text.

    Kinds are string, number, true, false and null; numbers are left as they are written. An empty
    object or list has no scalar. Raises ValueError where the text is no JSON, or not one document.
    """

    def __init__(self, blocks: Iterator[str]):
        self.blocks, self.held, self.at, self.passed, self.ended = blocks, "", 0, 0, False

    def _more(self) -> bool:
        """Take on another block. A space ends the text, so that its last token is whole."""
        if self.ended:
            return False
        block = next(self.blocks, None)
        self.ended = block is None
        self.passed += self.at
        self.held, self.at = self.held[self.at:] + (" " if block is None else block), 0
        return True

    def _fail(self, what: str) -> None:
        raise ValueError(f"{what} at character {self.passed + self.at}")

    def _match(self, pattern: re.Pattern) -> re.Match | None:
        found = pattern.match(self.held, self.at)
        if found:
            self.at = found.end()
        return found

    def _token(self) -> tuple[str, str]:
        while not (found := self._match(_TOKEN)):
            # A string that goes on for long is taken on by as much again each time.
            size = len(self.held) - self.at
            while self._more() and len(self.held) - self.at < 2 * size:
                pass
            if self.ended and not _TOKEN.match(self.held, self.at):
                self._fail("no JSON" if self.held[self.at:].strip() else "unexpected end")
        mark, string, number, word = found.groups()
        return (mark, mark) if mark else ("string", string) if string is not None else ("number", number) if number else (word, word)

    def __iter__(self) -> Iterator[tuple[list[str], str, str | None]]:
        path: list[str] = []
        lists: list[bool] = []
        yield from self._value(path, lists, *self._token())
        while lists:
            if lists[-1]:
                path[-1] = str(int(path[-1]) + 1)
                kind, token = self._token()
                if kind == "]" and path[-1] == "0":
                    self._close(path, lists)
                    yield from self._after(path, lists)
                    continue
            else:
                while member := self._match(_MEMBER):
                    path[-1] = _text(member[1])
                    yield path.copy(), "number", member[2]
                kind, token = self._token()
                if kind == "}" and path[-1] is None:
                    self._close(path, lists)
                    yield from self._after(path, lists)
                    continue
                if kind != "string":
                    self._fail("no name of a member")
                path[-1] = _text(token)
                if self._token()[0] != ":":
                    self._fail("no colon")
                kind, token = self._token()
            yield from self._value(path, lists, kind, token)
        while self._more():
            pass
        if self.held[self.at:].strip(" \t\r\n"):
            self._fail("more than one document")

    def _value(self, path: list, lists: list[bool], kind: str, token: str) -> Iterator[tuple]:
        if kind in "[{":
            lists.append(kind == "[")
            path.append("-1" if kind == "[" else None)
            return
        if kind in "]},:":
            self._fail("no value")
        yield path.copy(), kind, _text(token) if kind == "string" else token if kind == "number" else None
        yield from self._after(path, lists)

    def _close(self, path: list, lists: list[bool]) -> None:
        path.pop()
        lists.pop()

    def _after(self, path: list, lists: list[bool]) -> Iterator[tuple]:
        """Past the commas and the ends that follow a value."""
        while lists:
            kind, _ = self._token()
            if kind == ",":
                return
            if kind != ("]" if lists[-1] else "}"):
                self._fail("no end and no comma")
            self._close(path, lists)
        yield from ()


def _blocks(uri: str, size: int) -> Iterator[str]:
    system, path = _opened(uri)
    decoder = codecs.getincrementaldecoder("utf-8")()
    with system.open_input_stream(path) as f:
        while raw := f.read(size):
            yield decoder.decode(raw)
        yield decoder.decode(b"", True)


def _step(batches: Iterable, size: int) -> Iterator:
    import pyarrow as pa

    kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]
    names = ["file", "at", "path", "kind", "value"]

    def batch(uri: str, first: int, rows: list[tuple]):
        columns = [[uri] * len(rows), range(first, first + len(rows)), *zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for some in batches:
        for uri in some.column(0).to_pylist():
            first, rows = 0, []
            try:
                for item in Reader(_blocks(uri, size)):
                    rows.append(item)
                    if len(rows) >= _ROWS:
                        yield batch(uri, first, rows)
                        first, rows = first + len(rows), []
            except ValueError as e:
                raise ValueError(f"{uri}: {e}") from e
            if rows:
                yield batch(uri, first, rows)


def items(listed: DataFrame, block: int = BLOCK) -> DataFrame:
    """file, at, path, kind, value: every scalar of the JSON documents in `listed` files (path).

    `path` names the members and positions that lead to it, `at` counts the scalars before it in the
    file. One task reads one file, since only what comes before tells what a character means; many
    files are read side by side. A file that is no JSON fails the query and is named.
    """
    ship(listed.sparkSession)
    return listed.select("path").repartition("path").mapInArrow(partial(_step, size=block), ITEMS)
