"""HTML pages as columns: a structural index of the tags that matter, the
elements it gives, and cell text with every entity decoded.

``skeleton`` scans a page once as a tokenizer does: comments, declarations,
scripts and all tags other than the structural ones go, whatever ``<`` or ``>``
their quoted attributes hold, and each structural tag becomes one mark (a
Unicode noncharacter). ``elements`` then folds over the marks of a text with
the stack of open elements, so that nested tables keep their own rows, a
missing end tag is implied by the next element of the same table (or by the end
of the table), and a stray end tag does nothing. All of it is per row, in the JVM.
"""

from __future__ import annotations

import functools
import html.entities
import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewell.functions import scalars as S
from tradewell.functions.scalars import let

# The rest of a tag after its name: quotes count only after an equals sign.
ATTRS = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^>\s"'][^>\s]*+)?+|["'])*+"""
FIRST_MARK, TAG_OPEN, TAG_CLOSE = 0xFDD0, "﷞", "﷟"
NONCHARACTERS = "".join(map(chr, range(0xFDD0, 0xFDE0)))
SLOTS = 1024
# The characters that browsers take numbers 128 to 159 for, by rule.
BYTES = "".join(bytes([b]).decode("windows-1252", "ignore") or chr(b) for b in range(128, 160))


@dataclass(frozen=True)
class Marks:
    """The structural tags, outermost first; tag i opens with mark 2i and closes with 2i + 1."""

    tags: tuple[str, ...]

    def of(self, tag: str) -> tuple[str, str]:
        at = FIRST_MARK + 2 * self.tags.index(tag)
        return chr(at), chr(at + 1)


def skeleton(page, marks: Marks) -> Column:
    """The text of a page with marks for its structural tags and no other markup."""
    names = "|".join(marks.tags)
    markup = (rf"(?is)<(?:(/?(?:{names}))(?=[\s/>]){ATTRS}>|!--.*?(?:-->|\z)|(script|style)(?=[\s/>]){ATTRS}>.*?(?:</\2\s*>|\z)"
              rf"|[!?][^>]*+>|/?[a-z]{ATTRS}>)")
    page = S._c(page)
    page = F.when(page.rlike(f"[{NONCHARACTERS[0]}-{NONCHARACTERS[-1]}]"), F.translate(page, NONCHARACTERS, "")).otherwise(page)
    text = F.regexp_replace(page, markup, f"{TAG_OPEN}$1{TAG_CLOSE}")
    text = F.replace(text, F.lit(TAG_OPEN + TAG_CLOSE), F.lit(""))
    named = [(name, mark) for tag in marks.tags for name, mark in zip((tag, f"/{tag}"), marks.of(tag))]

    def marked(t, case):
        for name, mark in named:
            t = F.replace(t, F.lit(TAG_OPEN + case(name) + TAG_CLOSE), F.lit(mark))
        return t

    def mixed_case(t):
        for name, mark in named:
            t = F.regexp_replace(t, f"(?i){TAG_OPEN}{name}{TAG_CLOSE}", mark)
        return t

    # most pages write their tags in one case: look for the next only if tags are left
    left = lambda t, rest: F.when(t.contains(TAG_OPEN), rest(t)).otherwise(t)
    return let(marked(text, str.lower), lambda t: left(t, lambda t: let(marked(t, str.upper), lambda t: left(t, mixed_case))))


def elements(text, marks: Marks, tag: str, within: tuple[str, ...] = (), implied: bool = True, nested: bool = False) -> Column:
    """The contents (skeleton text) of the elements ``tag`` in order. ``within``
    are the tags that open a scope of their own; with ``nested`` elements of
    inner scopes count as well. With ``implied`` an element ends where the next
    one of its scope begins."""
    opening, closing = marks.of(tag)
    order = opening + closing + "".join(marks.of(t)[0] for t in within) + "".join(marks.of(t)[1] for t in within)
    first_end = 3 + len(within)
    kind = lambda p: F.when(p == "", 0).otherwise(F.position(F.substring(p, 1, 1), F.lit(order)))
    found_type = "array<struct<level: int, at: int, end: int>>"
    start = F.struct(F.array().cast("array<int>").alias("open"), F.array().cast(found_type).alias("found"))

    def step(acc, t):
        stack, found = acc["open"], acc["found"]
        n = F.size(stack)
        top = F.try_element_at(stack, F.lit(-1))   # the place of an open element, 0 for a scope
        held = F.coalesce(top > 0, F.lit(False))
        rest, outer = F.slice(stack, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(stack, F.lit(1), F.greatest(n - 2, F.lit(0)))
        ended = F.concat(found, F.array(F.struct((n - 1).alias("level"), top.alias("at"), t["at"].alias("end"))))
        opens, closes, scope_opens = t["k"] == 1, t["k"] == 2, (t["k"] > 2) & (t["k"] < first_end)
        shut = (opens & held & F.lit(implied)) | (closes & held) | (~opens & ~closes & ~scope_opens & held & (n > 1))
        after = (F.when(opens, F.concat(F.when(held & F.lit(implied), rest).otherwise(stack), F.array(t["at"])))
                 .when(closes, F.when(held, rest).otherwise(stack))
                 .when(scope_opens, F.concat(stack, F.array(F.lit(0))))
                 .when(held, F.when(n > 1, outer).otherwise(stack))
                 .otherwise(rest))
        return F.struct(after.alias("open"), F.when(shut, ended).otherwise(found).alias("found"))

    def of(pieces):
        tokens = F.filter(F.transform(pieces, lambda p, i: F.struct(kind(p).alias("k"), (i + 1).alias("at"))), lambda t: t["k"] > 0)

        def finish(acc):
            left = F.filter(F.transform(acc["open"], lambda at, i: F.struct(i.alias("level"), at.alias("at"), (F.size(pieces) + 1).alias("end"))),
                            lambda e: e["at"] > 0)
            return F.concat(acc["found"], left)

        found = F.aggregate(tokens, start, step, finish)
        if not nested:
            found = F.filter(found, lambda e: e["level"] == 0)
        by_place = F.array_sort(F.transform(found, lambda e: F.struct(e["at"].alias("at"), e["end"].alias("end"))))
        return F.transform(by_place, lambda e: F.concat(
            F.substring(F.element_at(pieces, e["at"]), 2, 1 << 30),
            F.array_join(F.slice(pieces, e["at"] + 1, e["end"] - e["at"] - 1), "")))

    general = lambda t: let(F.split(t, f"(?=[{order}])", -1), of)
    # without inner scopes an element ends at its end tag or where the next one begins
    flat = lambda t: F.transform(F.slice(F.split(t, opening, -1), 2, 1 << 30), lambda p: F.substring_index(p, closing, 1))
    inner = lambda t: functools.reduce(lambda x, y: x | y, [F.contains(t, F.lit(m)) for w in within for m in marks.of(w)], F.lit(False))
    if not implied:
        return general(text)
    return let(text, lambda t: F.when(inner(t), general(t)).otherwise(flat(t)))


def plain_text(content) -> Column:
    """Text of a skeleton's element: marks removed, entities decoded, stripped."""
    return let(F.translate(content, NONCHARACTERS, ""),
               lambda t: F.when(t.contains("&"), let(decode_entities(t), S.strip_ws)).otherwise(S.strip_ws(t)))


def _named() -> Column:
    """All named entities of HTML 5, by rule from Python's standard table, as an
    array of maps: slot crc32(name) modulo SLOTS. One constant of the plan."""
    slots: list[dict] = [{} for _ in range(SLOTS)]
    for name, text in sorted(html.entities.html5.items()):
        if name.endswith(";"):
            slots[zlib.crc32(name[:-1].encode()) % SLOTS][name[:-1]] = text
    return F.from_json(F.lit(json.dumps(slots)), "array<map<string, string>>")


def numbered(digits) -> Column:
    """The character of a numeric reference: decimal digits, or x and
    hexadecimal ones; NULL if there is none. 128 to 159 mean Windows-1252."""
    number = F.when(F.lower(F.substring(digits, 1, 1)) == "x", F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits)
    return let(number.try_cast("int"), lambda n: (
        F.when(n.between(128, 159), F.lit(BYTES).substr(n - 127, F.lit(1)))
        .when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))))


def decode_entities(text) -> Column:
    """Named and numeric entities, with or without the closing ``;``, each
    decoded once. Numbers 128 to 159 mean Windows-1252, as browsers read them.
    Unknown names and numbers that name no character stay as they are."""
    slots = _named()

    def named(name):
        slot = F.element_at(slots, (F.crc32(name.cast("binary")) % SLOTS + 1).cast("int"))
        return F.try_element_at(slot, name)

    def one(p):
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*)", 1)
        both = let(name, lambda n: F.struct(n.alias("n"), F.when(n.startswith("#"), numbered(F.substring(n, 2, 7))).when(n != "", named(n)).alias("c")))
        end = lambda x: F.length(x["n"]) + F.when(p.substr(F.length(x["n"]) + 1, F.lit(1)) == ";", 2).otherwise(1)
        return let(both, lambda x: F.when(x["c"].isNull(), F.concat(F.lit("&"), p)).otherwise(
            F.concat(x["c"], p.substr(end(x), F.length(p)))))

    return let(F.split(text, "&", -1), lambda pieces: F.concat(
        F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, 2, 1 << 30), one), "")))
