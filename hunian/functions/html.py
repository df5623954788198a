"""Fields out of page markup with Spark's own regex and array functions.

Selectors are small values (tag and class tokens); each turns into one Java
pattern. Patterns are unrolled and possessive: they run in linear time and the
regex stack does not grow with the length of a page.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import trim_text

# The rest of a tag after its name, quoted attribute values may hold '>'.
ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>"""
_BEFORE = r"""[^>"']*?(?:(?:"[^"]*+"|'[^']*+')[^>"']*?)*?"""
_ANY_TAG = r"</?[a-zA-Z]" + ATTRIBUTES


def _raw_text(tag: str) -> str:
    """Rest of an element whose content is no markup, after the '<'."""
    return rf"(?i:{tag})(?=[\s>/])[^<]*+(?:<(?!/(?i:{tag})[\s>])[^<]*+)*+</(?i:{tag})\s*>"


_NOT_MARKUP = rf"<(?:!--[^-]*+(?:-(?!->)[^-]*+)*+-->|{_raw_text('script')}|{_raw_text('style')})"


@dataclass(frozen=True)
class Selector:
    """An element by tag, class tokens and, for links, the start of ``href``."""

    tag: str
    classes: tuple[str, ...] = ()
    href_prefix: str | None = None

    @property
    def opening(self) -> str:
        tests = "".join(_attribute("class", rf"(?:{{any}}\s)?\Q{c}\E(?:\s{{any}})?") for c in self.classes)
        if self.href_prefix is not None:
            tests += _attribute("href", rf"\Q{self.href_prefix}\E{{any}}")
        return rf"<(?i:{self.tag})(?=[\s>/]){tests}{ATTRIBUTES}"


def _attribute(name: str, value: str) -> str:
    """Look ahead for an attribute; ``{any}`` in ``value`` is any run inside the quotes."""
    double, single = value.replace("{any}", '[^"]*'), value.replace("{any}", "[^']*")
    return rf"""(?={_BEFORE}\s(?i:{name})\s*=\s*(?:"{double}"|'{single}'))"""


def inside(tag: str, *stops: str) -> str:
    """Anything up to the next opening or closing ``tag`` (or one of ``stops``)."""
    names = "|".join((tag, *stops))
    return rf"[^<]*+(?:<(?!/?(?i:{names})[\s>/])[^<]*+)*+"


def visible_markup(html: Column) -> Column:
    """Markup without comments, scripts and style sheets, whose text is no element."""
    return F.regexp_replace(html, _NOT_MARKUP, "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode_entities(text: Column) -> Column:
    """Decode named and numeric entities in one pass, so ``&amp;lt;`` stays ``&lt;``."""
    table = {f"&{name}": text for name, text in html5.items() if name.endswith(";")}
    names = F.from_json(F.lit(json.dumps(table)), "map<string,string>")
    token = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|\w+);|[^&]++|&"

    def decoded(text: Column) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(token), F.lit(0))
        return F.array_join(F.transform(tokens, lambda t: F.when(~t.startswith("&"), t).otherwise(
            F.coalesce(_code_point(t), F.try_element_at(names, t), t))), "")

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), decoded(t)).otherwise(t))


def _code_point(token: Column) -> Column:
    """The character of a numeric entity; null for anything else."""
    decimal = F.conv(F.regexp_extract(token, r"^&#([0-9]+);$", 1), 10, 16)
    hexadecimal = F.regexp_extract(token, r"^&#[xX]([0-9a-fA-F]+);$", 1)
    digits = F.coalesce(F.nullif(hexadecimal, F.lit("")), decimal)
    # Surrogates and numbers past the last code point are not characters.
    valid = token.rlike("^&#") & (F.length(digits) <= 6) & ~F.lpad(digits, 6, "0").rlike(
        "(?i)^(00d[89a-f]|1[1-9a-f]|[2-9a-f])")
    return F.when(valid, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))


def element_text(inner: Column) -> Column:
    """Text of an element: nested tags dropped, entities decoded, ends trimmed."""
    plain = F.regexp_replace(inner, _ANY_TAG, "")
    return trim_text(F.when(F.contains(inner, F.lit("&")), decode_entities(plain)).otherwise(plain))


def pieces(markup: Column, selector: Selector) -> Column:
    """The markup from each match of ``selector`` up to the next match, in page order."""
    parts = F.split(markup, f"(?={selector.opening})")
    return F.filter(parts, lambda p: p.rlike("^" + selector.opening))


def from_first(markup: Column, selector: Selector) -> Column:
    """The first match up to its end tag, or to the end of ``markup`` if it holds its like.

    One search, which for a plain element does not read on; null without a match.
    """
    plain = rf"{inside(selector.tag)}</(?i:{selector.tag})\s*>"
    return F.regexp_substr(markup, F.lit(rf"{selector.opening}(?:{plain}|(?s:.*))"))


def up_to_end(text: Column, tag: Column) -> Column:
    """Cut ``text``, which starts with an opening ``tag``, after the matching end tag.

    The parts between end tags are walked with a depth counter; without a
    matching end tag the whole text is the element.
    """
    start = F.struct(F.lit(0).alias("taken"), F.lit(0).alias("open"))
    end_tag = F.concat(F.lit("</"), tag, F.lit(">"))

    def step(state: Column, opened: Column) -> Column:
        done = (state["taken"] > 0) & (state["open"] == 0)
        return F.when(done, state).otherwise(F.struct(
            (state["taken"] + 1).alias("taken"), (state["open"] + opened - 1).alias("open")))

    def cut(parts: Column) -> Column:
        opening = F.concat(F.lit("<(?i:"), tag, F.lit(r")(?=[\s>/])"))
        opened = F.transform(parts, lambda p: F.size(F.split(p, opening)) - 1)
        return let(F.aggregate(opened, start, step)["taken"], lambda taken: F.concat(
            F.call_function("array_join", F.slice(parts, 1, taken), end_tag),
            F.when(taken < F.size(parts), end_tag).otherwise("")))

    return let(F.split(text, F.concat(F.lit("</(?i:"), tag, F.lit(r")\s*>"))), cut)


def elements(markup: Column, selectors: list[Selector]) -> Column:
    """Array with the first match of each selector, from opening to end tag, or null."""
    found = F.array(*[
        F.struct(from_first(markup, s).alias("text"), F.lit(s.tag).alias("tag")) for s in selectors])
    return F.transform(found, lambda f: up_to_end(f["text"], f["tag"]))


def element(markup: Column, selector: Selector, index: int = 0) -> Column:
    """The ``index``-th match from its opening to its end tag; null if there are fewer."""
    if index:
        markup = let(pieces(markup, selector), lambda found: F.when(
            F.size(found) > index, F.array_join(F.slice(found, index + 1, F.size(found)), "")))
    return let(from_first(markup, selector), lambda text: up_to_end(text, F.lit(selector.tag)))


def selected_text(markup: Column, selector: Selector, index: int = 0) -> Column:
    return let(element(markup, selector, index), element_text)


def attribute(tag_text: Column, name: str) -> Column:
    """Value of an attribute of the first tag in ``tag_text``; null if it has none."""
    pattern = rf"""^<{_BEFORE}\s(?i:{name})\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    value = F.concat(F.regexp_extract(tag_text, pattern, 1), F.regexp_extract(tag_text, pattern, 2))
    return F.when(tag_text.rlike(pattern), let(value, decode_entities))


def labelled_pairs(markup: Column, labels: list[str], tag: str = "p") -> Column:
    """Array of (label, value) of adjacent sibling paragraphs: label text, value markup.

    Paragraphs that cannot hold one of ``labels`` are left out by one search,
    before their text is cleaned; inside markup or entities a label may hide.
    """
    paragraph = rf"<(?i:{tag})(?=[\s>/]){ATTRIBUTES}({inside(tag)})</(?i:{tag})\s*>"
    adjacent = rf"{paragraph}(?=[^<]*+{paragraph})"
    starts = "".join(sorted({re.escape(label[0]) for label in labels}))
    candidate = rf"[<&]|(?=[{starts}])(?:{'|'.join(map(re.escape, labels))})"
    found = F.arrays_zip(
        F.regexp_extract_all(markup, F.lit(adjacent), F.lit(1)).alias("label"),
        F.regexp_extract_all(markup, F.lit(adjacent), F.lit(2)).alias("value"))
    return F.transform(
        F.filter(found, lambda p: p["label"].rlike(candidate)),
        lambda p: F.struct(element_text(p["label"]).alias("label"), p["value"].alias("value")))


def labelled_markup(pairs: Column, label: Column, exact: bool = False) -> Column:
    """Value markup after the first paragraph that contains ``label`` (or equals it)."""
    hit = F.filter(pairs, lambda p: p["label"] == label if exact else F.contains(p["label"], label))
    return F.get(hit, F.lit(0))["value"]


def labelled_value(pairs: Column, label: str, exact: bool = False) -> Column:
    return let(labelled_markup(pairs, F.lit(label), exact), element_text)
