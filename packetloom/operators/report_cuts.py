"""Reports of the usual form, cut by position on whole Arrow batches: as an XML parser reads them, at a fraction of its time.

The usual form is what servers send: header attributes in their order, sections of plain elements and, in all but the links' section, the known
blocks of plain elements. It has no blanks, references, empty values or elements inside elements, so nothing is left to a parser to decide. Any
other report is told apart here and goes to the parser.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

HEADER = ["tod", "ver", "src", "tos", "pgm", "ins", "pid", "site"]
BLOCKS = {"sys": "s|u", "usr": "s|u", "ops": "open|pr|rd|rv|sync|wr", "lgn": "num|af|au|ua"}
#: Rows of a batch worked on at a time.
ROWS = 2000


_VALUE = "[!#-%'-;=?-~]+"
#: Layouts (reports without their values) that a task remembers.
LAYOUTS = 1000


def usual_form() -> re.Pattern[bytes]:
    def leaf(n: int) -> str:
        return rf"<((?!(?:sys|usr|ops|lgn|stats)>)[a-z]+)>{_VALUE}</\{n}>"

    blocks = "".join(rf"|<{name}>(?:<({inner})>{_VALUE}</\{i + 3}>)+</{name}>" for i, (name, inner) in enumerate(BLOCKS.items()))
    links = rf'<stats id="link">(?:{leaf(1)})*</stats>'
    others = rf'<stats id="(?!link")[a-z]+">(?:{leaf(2)}{blocks})*</stats>'
    return re.compile(rf"(?:{links}|{others})*</statistics>".encode())


def _cut(whole: bytes | None, start: bytes, end: bytes) -> bytes | None:
    """What stands between the last `start` and the next `end`: of repeated elements the last one counts."""
    at = -1 if whole is None else whole.rfind(start)
    if at < 0:
        return None
    at += len(start)
    return whole[at : whole.index(end, at)]


class Cutter:
    """Cuts reports into the header's attributes and, per section, a mark that it is there and its elements (`block.element`).

    Reports of a server differ in their values only, so where an element's value stands is found once per layout.
    """

    HEAD = re.compile(("<statistics" + "".join(rf'(?: {name}="({_VALUE})")?' for name in HEADER)).encode())
    VALUES = re.compile(f">({_VALUE})<".encode())

    def __init__(self, attributes: list[str], sections: dict[str, list[str]]):
        self.usual, self.sections = usual_form(), sections
        self.groups = [HEADER.index(a) + 1 for a in attributes]
        self.places: dict[tuple[bytes, ...], list[int] | None] = {}

    def _place(self, body: bytes, parts: list[bytes]) -> list[int] | None:
        """For every column the number of its value in a report of this layout, from the end on; None for unusual layouts."""
        if self.usual.fullmatch(body) is None:
            return None
        numbered = list(parts)
        numbered[1::2] = [b">%d<" % i for i in range(len(parts) // 2)]
        report, found = b"".join(numbered), []
        for name, paths in self.sections.items():
            whole = _cut(report, f'<stats id="{name}">'.encode(), b"</stats>")
            found.append(-1 if whole is None else -2)
            for path in paths:
                block, _, element = path.rpartition(".")
                of = _cut(whole, f"<{block}>".encode(), f"</{block}>".encode()) if block else whole
                value = _cut(of, f"<{element}>".encode(), b"<")
                found.append(-1 if value is None else int(value))
        return found

    def read(self, report: bytes | None) -> list[bytes | None] | None:
        """None for reports that are not of the usual form."""
        head, _, body = (report or b"").partition(b">")
        header = self.HEAD.fullmatch(head)
        if header is None:
            return None
        parts = self.VALUES.split(body)
        layout = tuple(parts[::2])
        if layout in self.places:
            places = self.places[layout]
        else:
            places = self._place(body, parts)
            if len(self.places) < LAYOUTS:
                self.places[layout] = places
        if places is None:
            return None
        values = [*parts[1::2], b"1", None]  # the last two: there, not there
        return [*header.group(*self.groups), *[values[i] for i in places]]


def cut_batches(
    batches: Iterator[pa.RecordBatch], attributes: list[str], sections: dict[str, list[str]], names: list[str]
) -> Iterator[pa.RecordBatch]:
    """Batches with a column `usual` and those of `Cutter`."""
    cutter = Cutter(attributes, sections)
    nothing = [None] * (len(attributes) + sum(1 + len(paths) for paths in sections.values()))
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            found = [cutter.read(r) for r in part.column("payload").to_pylist()]
            fits = pa.array([r is not None for r in found], pa.bool_())
            columns = [pa.array(c, pa.binary()).cast(pa.string()) for c in zip(*[nothing if r is None else r for r in found])]
            yield pa.RecordBatch.from_arrays([*part.columns, fits, *columns], names)
