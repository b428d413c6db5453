"""Semi-structured text to rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T



def explode_json_records(
    df: DataFrame, col: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per object of a JSON list; text that is not a list gives none.

    Missing text fields become the empty string. ``from_json`` would turn a bare object into a
    one-row list, so the text must start with ``[``.
    """
    text = F.ltrim(F.col(col))
    records = F.when(text.startswith("["), F.from_json(text, T.ArrayType(schema)))
    rows = df.select(*keep, F.explode(records).alias("_r")).where("_r is not null")
    return rows.select(*keep, *[_filled(f) for f in schema.fields])


def _filled(f: T.StructField) -> Column:
    value = F.col("_r").getField(f.name)
    if isinstance(f.dataType, T.StringType):
        value = F.coalesce(value, F.lit(""))
    return value.alias(f.name)


def json_field(c: Column, name: str, default: str = "") -> Column:
    return F.coalesce(F.get_json_object(c, f"$.{name}"), F.lit(default))


def extract_pattern_records(
    pages: DataFrame,
    html: str,
    block: str,
    fields: Mapping[str, str],
    keep: Sequence[str] = ("page_id", "url"),
) -> DataFrame:
    """Records cut out of flat markup by patterns, all inside the JVM.

    ``block`` matches one record; each field pattern has one group and is applied to the block.
    A field that does not match is the empty string.
    """
    blocks = F.regexp_extract_all(F.col(html), F.lit(block), F.lit(0))
    rows = pages.select(*keep, F.posexplode(blocks).alias("pos", "_block"))
    return rows.select(
        *keep, "pos",
        *[F.regexp_extract("_block", pattern, 1).alias(name) for name, pattern in fields.items()],
    )


@dataclass(frozen=True)
class Element:
    """A tag with classes it must carry."""

    tag: str
    classes: tuple[str, ...] = ()

    def fits(self, tag: str, classes: frozenset[str]) -> bool:
        return self.tag == tag and classes.issuperset(self.classes)


@dataclass(frozen=True)
class FieldRule:
    """Where a field lies inside an item: a chain of elements, then an attribute or the text.

    With both ``attr`` and ``text`` the attribute is preferred and the text is the fallback. An
    empty chain means the item itself. ``sep`` stands between the text pieces of nested tags.
    """

    path: tuple[Element, ...] = ()
    attr: str | None = None
    text: bool = False
    sep: str = " "


@dataclass(frozen=True)
class ListingRule:
    item: Element
    fields: Mapping[str, FieldRule] = field(default_factory=dict)


# Markup of the two article listings.
LISTING_EPOCH = ListingRule(
    Element("article", ("item-news", "item-news-common")),
    {
        "title": FieldRule((Element("h3", ("title-news",)), Element("a")), text=True, sep=""),
        "url": FieldRule((Element("h3", ("title-news",)), Element("a")), attr="href"),
        "summary": FieldRule((Element("p", ("description",)), Element("a")), text=True),
        "published": FieldRule(attr="data-publishtime"),
    },
)
LISTING_ISO = ListingRule(
    Element("div", ("box-category-item",)),
    {
        "title": FieldRule(
            (Element("a", ("box-category-link-title",)),), attr="title", text=True, sep=""),
        "url": FieldRule((Element("a", ("box-category-link-title",)),), attr="href"),
        "summary": FieldRule((Element("a", ("box-category-sapo",)),), attr="title", text=True),
        "published": FieldRule((Element("div", ("box-time",)),), attr="title"),
    },
)

_VOID = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)


class _Listing(HTMLParser):
    """Collects the records of one page."""

    def __init__(self, rule: ListingRule):
        super().__init__(convert_charrefs=True)
        self.rule, self.records = rule, []
        self.open: list[tuple[str, frozenset[str]]] = []
        self.item_depth: int | None = None

    def handle_starttag(self, tag, attrs):
        attributes = {k: v or "" for k, v in attrs}
        classes = frozenset(attributes.get("class", "").split())
        if self.item_depth is None and self.rule.item.fits(tag, classes):
            self.item_depth = len(self.open)
            self.values: dict[str, str] = {}
            self.pieces: dict[str, list[str]] = {}
            self.reading: dict[str, int] = {}
            self._take(tag, classes, attributes, own=True)
        elif self.item_depth is not None:
            self._take(tag, classes, attributes, own=False)
        if tag not in _VOID:
            self.open.append((tag, classes))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _take(self, tag, classes, attributes, own):
        inside = [] if own else self.open[self.item_depth + 1:]
        for name, rule in self.rule.fields.items():
            if name in self.values or name in self.pieces or own != (not rule.path):
                continue
            if rule.path and not (rule.path[-1].fits(tag, classes)
                                  and _descends(rule.path[:-1], inside)):
                continue
            value = attributes.get(rule.attr, "") if rule.attr else ""
            if value or not rule.text:
                self.values[name] = value
            else:
                self.pieces[name], self.reading[name] = [], len(self.open)

    def handle_data(self, data):
        if self.item_depth is not None:
            for name in self.reading:
                self.pieces[name].append(data.strip())

    def handle_endtag(self, tag):
        depth = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if depth is None:
            return
        del self.open[depth:]
        if self.item_depth is None:
            return
        self.reading = {n: d for n, d in self.reading.items() if d < depth}
        if depth <= self.item_depth:
            self._finish()

    def _finish(self):
        texts = {
            n: self.rule.fields[n].sep.join(p for p in parts if p)
            for n, parts in self.pieces.items()
        }
        self.records.append({n: self.values.get(n, texts.get(n, "")) for n in self.rule.fields})
        self.item_depth = None

    def close(self):
        super().close()
        if self.item_depth is not None:
            self._finish()


def _descends(path, inside) -> bool:
    """Whether the elements of ``path`` occur in this order among the open ones."""
    rest = iter(inside)
    return all(any(step.fits(*element) for element in rest) for step in path)


def extract_records(
    pages: DataFrame, rule: ListingRule, html: str = "html",
    keep: Sequence[str] = ("page_id", "url"), prefix: str = "",
) -> DataFrame:
    """``keep`` columns, ``pos`` and one text column per field, one row per listed item.

    Real listings nest, so each page goes through the standard HTML parser, in Arrow batches and
    without a shuffle, but for inputs too small to fill the cores. ``prefix`` is put before field names that clash with a kept column.
    """
    kept, names = list(keep), [prefix + n for n in rule.fields]
    schema = T.StructType(
        [pages.schema[c] for c in kept] + [T.StructField("pos", T.IntegerType())]
        + [T.StructField(n, T.StringType()) for n in names]
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for values in batch.itertuples(index=False):
                parser = _Listing(rule)
                parser.feed(values[-1] or "")
                parser.close()
                for pos, record in enumerate(parser.records):
                    rows.append((*values[:-1], pos, *record.values()))
            yield pd.DataFrame(rows, columns=schema.names)

    return pages.select(*kept, html).mapInPandas(parse, schema)
