"""Records from saved pages. The one place where rows pass through Python, in Arrow batches."""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Ships this small module inside the UDF, so the executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements whose end tag may be omitted, and what begins after their end.
_BLOCKS = (
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul"
)
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "p": set(_BLOCKS.split()) | {"li", "dt", "dd", "td", "th", "tr"},
    "option": {"option", "optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"},
}
# A start tag inside one of these ends nothing outside it.
HOLDS_ITS_OWN = frozenset("ul ol menu dl table select".split())


@dataclass(frozen=True)
class Element:
    """Which element to take: tag, attribute values that must match, and what to read from it.

    A ``class`` matches when all its words are among the element's classes. ``read`` is ``"text"`` or an
    attribute name. ``within`` lists elements that must be open around it, the outermost first, with anything between.
    """

    tag: str | None = None
    attrs: dict[str, str] = field(default_factory=dict)
    read: str = "text"
    within: tuple[Element, ...] = ()

    def matches(self, tag: str, attrs: dict[str, str]) -> bool:
        if self.tag is not None and tag != self.tag:
            return False
        for name, wanted in self.attrs.items():
            have = attrs.get(name)
            if have is None:
                return False
            if name == "class":
                if not set(wanted.split()) <= set(have.split()):
                    return False
            elif have != wanted:
                return False
        return True


#: What starts after an omitted end tag, to the elements that it ends.
ENDS = {tag: [there for there, ends in ENDED_BY.items() if tag in ends] for tag in set().union(*ENDED_BY.values())}


class _Collector(HTMLParser):
    """Collects, per container element, the first value of every wanted field.

    Open elements are kept as a stack. A container inside another gives a record of its own; what lies in
    the inner one lies in the outer one as well. Elements whose end tag may be omitted end where the next
    one of their kind begins, others at the end of what holds them.

    The work is linear in the page: the places of each tag on the stack are listed, so no end tag searches it; a field knows
    the open records that still wait for it; texts are ranges of one buffer, cut out at the end; and how far the ``within`` of
    each wanted element is met is a number that an element hands down to what it holds.
    """

    def __init__(self, container: Element, fields: dict[str, Element]):
        super().__init__(convert_charrefs=True)
        self.container, self.fields = container, fields
        self.records: list[dict] = []
        self._tags: list[str] = []
        self._places: dict[str, list[int]] = {}
        self._holders: list[int] = []
        self._waiting: dict[str, list[tuple[int, dict]]] = {name: [] for name in fields}
        self._reading: list[tuple[int, list[int]]] = []
        self._pieces: list[str] = []
        self._size = 0
        self._scoped = [e for e in dict.fromkeys(map(_Known, [container, *fields.values()])) if e.element.within]
        self._met: list[tuple[int, ...]] = [(0,) * len(self._scoped)]
        self._number = {e: i for i, e in enumerate(self._scoped)}

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        self._end_omitted(tag)
        place = len(self._tags)
        if self._fits(self.container, tag, attrs):
            record = dict.fromkeys(self.fields)
            self.records.append(record)
            for waiting in self._waiting.values():
                waiting.append((place, record))
        for name, wanted in self.fields.items():
            waiting = self._waiting[name]
            if not waiting or wanted.read != "text" and wanted.read not in attrs or not self._fits(wanted, tag, attrs):
                continue
            value = attrs[wanted.read] if wanted.read != "text" else [self._size, self._size]
            for _, record in waiting:
                record[name] = value
            waiting.clear()
            if wanted.read == "text" and tag not in VOID:
                self._reading.append((place, value))
        if tag in VOID:
            self._forget(place)
            return
        self._tags.append(tag)
        self._places.setdefault(tag, []).append(place)
        if tag in HOLDS_ITS_OWN:
            self._holders.append(place)
        met = self._met[-1]
        for i, known in enumerate(self._scoped):
            around = known.element.within
            if met[i] < len(around) and around[met[i]].matches(tag, attrs):
                met = (*met[:i], met[i] + 1, *met[i + 1 :])
        self._met.append(met)

    def _fits(self, wanted: Element, tag: str, attrs: dict[str, str]) -> bool:
        if not wanted.matches(tag, attrs):
            return False
        return not wanted.within or self._met[-1][self._number[_Known(wanted)]] == len(wanted.within)

    def _end_omitted(self, tag: str) -> None:
        """End the open elements that the start of ``tag`` implies, down to one that holds its own."""
        held = self._holders[-1] if self._holders else -1
        first = [places[at] for there in ENDS.get(tag, ()) if (at := bisect_right(places := self._places.get(there, []), held)) < len(places)]
        if first:
            self._end(min(first))

    def handle_data(self, data):
        if self._reading:
            self._pieces.append(data)
            self._size += len(data)

    def handle_endtag(self, tag):
        places = self._places.get(tag)
        if places:
            self._end(places[-1])

    def _end(self, at: int) -> None:
        """End the open element at this place of the stack and all inside it."""
        while len(self._tags) > at:
            self._places[self._tags.pop()].pop()
            self._met.pop()
        while self._holders and self._holders[-1] >= at:
            self._holders.pop()
        while self._reading and self._reading[-1][0] >= at:
            self._reading.pop()[1][1] = self._size
        self._forget(at)

    def _forget(self, at: int) -> None:
        for waiting in self._waiting.values():
            while waiting and waiting[-1][0] >= at:
                waiting.pop()

    def close(self):
        super().close()
        self._end(0)
        text = "".join(self._pieces)
        for record in self.records:
            for name, value in record.items():
                if isinstance(value, list):
                    record[name] = text[value[0] : value[1]]


@dataclass(frozen=True, eq=False)
class _Known:
    """An element by identity: its attributes are no key."""

    element: Element

    def __hash__(self):
        return id(self.element)

    def __eq__(self, other):
        return self.element is other.element


def page_records(html: str | None, container: Element, fields: dict[str, Element]) -> list[dict]:
    """The records of one page, in page order."""
    collector = _Collector(container, fields)
    collector.feed(html or "")
    collector.close()
    return collector.records


#: Pages and bytes of pages that are Python texts and records at one time.
STEP, STEP_BYTES = 256, 4 << 20


def _steps(pages: pa.Array) -> Iterator[pa.Array]:
    """A batch in parts of few pages and bytes, a larger page alone. Only one part at a time leaves Arrow's memory."""
    begin = size = 0
    for at, length in enumerate(pc.fill_null(pc.binary_length(pages), 0).to_pylist()):
        if at > begin and (at - begin == STEP or size + length > STEP_BYTES):
            yield pages.slice(begin, at - begin)
            begin, size = at, 0
        size += length
    if begin < len(pages) or not len(pages):
        yield pages.slice(begin)


def extract_html(df: DataFrame, column: str, container: Element, fields: dict[str, Element]) -> DataFrame:
    """One row per container element: the other columns plus one text column per field.

    A field is the first matching element inside the container, or the container itself; null when there
    is none. Containers inside containers give rows of their own. Only the page text goes to Python; rows come back as Arrow batches.
    """
    schema = "array<struct<" + ", ".join(f"`{name}`: string" for name in fields) + ">>"
    kind = pa.list_(pa.struct([pa.field(name, pa.string()) for name in fields]))

    @F.arrow_udf(schema)
    def records(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in pages:
            for part in _steps(batch):
                yield pa.array([page_records(html, container, fields) for html in part.to_pylist()], kind)

    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.explode(records(F.col(column))).alias("_record")).select(*kept, "_record.*")
