"""Column functions that clean and read the text of page cells. All are built-in expressions, so they stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchledger.functions.letters import ascii_letters, lowered
from matchledger.schema import ROUND_SYNONYMS, ROUNDS

# Marks and phrases of the pages, as they are written there.
#: Notes, which clean() removes first.
NOTES = ((r"(?is)<ref[^>]*>.*?</ref>", ""), (r"(?i)<ref[^>]*/>", ""))
#: Opens a template whose text stays, whatever templates are in it.
WRAPPER = r"\{\{\s*nowrap\s*\|"
#: What clean() removes or replaces then, in order: (pattern, replacement). The order matters.
CLEANING = (
    (r"\{\{[^{}]*\}\}", ""),
    (r"(?i)\[\[\s*(?:Archivo|File|Imagen|Image)\s*:[^\]]*\]\]", ""),
    (r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1"),
    ("'''", ""),
    ("''", ""),
    (r"(?is)<sup[^>]*>.*?</sup>", ""),
    (r"<[^>]+>", " "),
    (r"(?U)\s+", " "),
    (r"^ | $", ""),
    ("[¹²³⁰-₟]+$", ""),
    (r" $", ""),
    (r"^(.+?) ?\(\*+\)$", "$1"),
)
DESK = "se le dio por (?:ganado|perdido)|se lo dio (?:por )?ganado|le dio por ganado|otorg[aá]ndole|le gan[oó] los puntos|(?:mala|indebida) inclusi[oó]n|inclusi[oó]n indebida"
UNFINISHED = "suspendid|abandon[oó]|no se present[oó]|interrumpi"
RULING = "suspendid|abandon|no se present|tribunal|se le dio por|dio por (?:ganado|perdido|terminado|finalizado)|d[aá]ndolo por|otorg[aá]ndole|inclusi[oó]n indebida|mala inclusi[oó]n"
COMPLETED = r"se\s+(?:jug[oó]|jugaron|jugar[aá]n?|disput[oó]|disputaron|complet[oó]|reanud[oó]|finaliz[oó])\s+(?:el\s+)?\d{1,2}\s*de\s+[a-záéíóúñ]+"
SCORE = r"^\s*(?:\(\d+\)\s*)?(\d+)\s*[-:–—]\s*(\d+)"
ROUND_TITLE = (
    "(?iu)^(desempate|ronda de desempate|reducido|(octavos|cuartos|dieciseisavos|treintaidosavos)( de final)?|semifinal(es)?|final\\b"
    "|primera ronda|segunda ronda|tercera ronda|partidos? de (ida|vuelta|desempate)|promoci[oó]n)"
)


# What cleans texts is written as SQL: one expression that is parsed at once takes a thousandth of the calls that building
# it from columns takes, and cells are cleaned in many places.


def _raw(pattern: str) -> str:
    assert '"' not in pattern
    return f'r"{pattern}"'


def _replaced(value: str, steps: tuple[tuple[str, str], ...]) -> str:
    return reduce(lambda v, step: f"regexp_replace({v}, {_raw(step[0])}, {_raw(step[1])})", steps, value)


def _once(name: str, value: str, body: str) -> str:
    """body, in which `name` is the value: computed once, however often it is used."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


# A closing pair of braces goes with the last open pair, and those of wrappers are left out. What is open is a list: of
# wrappers their places, of other braces -1. From the first wrapper on that is never closed, only openings are left out.
_TOKENS = rf"(?is)({WRAPPER}|\{{(?={WRAPPER})|\{{\{{|\}}\}}|[^{{}}]+|.)"
_NUMBERED = "transform(ts, (t, i) -> struct(t AS t, i AS i))"


def _open(stack: str, place: str) -> str:
    less = f"slice({stack}, 1, greatest(size({stack}) - 1, 0))"
    return f"CASE WHEN startswith(x.t, '{{{{') THEN concat({stack}, array(IF(length(x.t) > 2, {place}, -1))) WHEN x.t = '}}}}' THEN {less} ELSE {stack} END"


_LEFT = f"aggregate({_NUMBERED}, CAST(array() AS array<int>), (s, x) -> {_open('s', 'x.i')})"
_DROPS = "(startswith(x.t, '{{') AND length(x.t) > 2) OR (x.t = '}}' AND coalesce(try_element_at(s.stack, -1) >= 0, false))"
_STEP = f"named_struct('out', IF({_DROPS}, s.out, concat(s.out, x.t)), 'stack', {_open('s.stack', 'IF(x.i < until, x.i, -1)')})"
_KEPT = f"aggregate({_NUMBERED}, named_struct('out', '', 'stack', CAST(array() AS array<int>)), (s, x) -> {_STEP}, s -> s.out)"
#: Templates that hold no others; their wrappers are told apart by one expression.
FLAT = r"^(?:[^{}]++|\{\{[^{}]*+\}\}(?!\}))*+\z"
_FLAT_WRAPPERS = ((r"(?is)" + WRAPPER + r"([^{}]*)\}\}", "$1"),)
_NESTED = _once("ts", f"regexp_extract_all(u, {_raw(_TOKENS)}, 1)", _once("until", f"coalesce(array_min(filter({_LEFT}, i -> i >= 0)), size(ts))", _KEPT))
_UNWRAPPED = f"IF(u rlike {_raw(FLAT)}, {_replaced('u', _FLAT_WRAPPERS)}, {_NESTED})"


#: Words with single spaces between them, of characters that no step of cleaning looks for; most cells are like this.
PLAIN = r"^[A-Za-z0-9À-ÿ.,:;+/()-]++(?: [A-Za-z0-9À-ÿ.,:;+/()-]++)*+\z"  # not $, which is before a last line break, too
_LINKS = 3  # so many steps of CLEANING take templates and links away, after which most texts are plain


def _cleaned(value: str) -> str:
    told = _once("u", f"IF(contains(t, '<'), {_replaced('t', NOTES)}, t)", f"IF(contains(u, '{{{{') AND u rlike {_raw('(?i)' + WRAPPER)}, {_UNWRAPPED}, u)")
    # a step is taken only where a text has what it begins with
    bare = _once("x", told, f"IF(contains(x, '{{{{'), {_replaced('x', CLEANING[:1])}, x)")
    shown = _once("y", bare, f"IF(contains(y, '[['), {_replaced('y', CLEANING[1:_LINKS])}, y)")
    visible = _once("w", shown, f"IF(w = '' OR w rlike {_raw(PLAIN)}, w, trim({_replaced('w', CLEANING[_LINKS:])}))")
    return _once("t", f"trim({value})", f"IF(t rlike {_raw(PLAIN)}, t, {visible})")


def _each(texts: Column, body: str) -> Column:
    """An array of texts, of each what the SQL says of `v`."""
    return F.call_function("transform", texts, F.expr(f"v -> {body}"))


def unwrapped(text: Column) -> Column:
    """Text without its wrappers, however deep templates nest in them."""
    return F.get(_each(F.array(text), _once("u", "v", _UNWRAPPED)), 0)


def cleaned(texts: Column) -> Column:
    """clean() of each text of an array."""
    return _each(texts, _cleaned("v"))


def clean(text: Column) -> Column:
    """The visible text of a cell: without notes, templates, links' targets, tags and marks."""
    return F.get(cleaned(F.array(text)), 0)


def number(digits: Column) -> Column:
    """The number of a text that regexp_extract() found; null for ''. A cast of '' fails, which takes longer than all else in a row."""
    return F.when(digits != "", digits).try_cast("int")


def cell_span(raw: Column) -> Column:
    """How many rows a cell fills; 1 if it does not say."""
    attributes = F.regexp_extract(raw, r"(?s)^\s*([^|]*?)\|(?!\|)", 1)
    told = r'(?i)rowspan\s*=\s*"?(\d+)'
    return F.when(raw.rlike(told), F.coalesce(number(F.regexp_extract(attributes, told, 1)), F.lit(1))).otherwise(1)


ATTRIBUTES = r"(?s)^(?![^|]*(?:\[\[|\{\{))\s*[^|]*?[\w-]+\s*=[^|]*\|(?!\|)"


def cell_texts(raws: Column) -> Column:
    """Of each raw cell of an array its visible text, without its attributes. What stands before a bar is an attribute only if it looks like one."""
    return _each(raws, _cleaned(f"IF(contains(v, '|'), {_replaced('v', ((ATTRIBUTES, ''),))}, v)"))


def cell_text(raw: Column) -> Column:
    return F.get(cell_texts(F.array(raw)), 0)


def row_cells(row: Column) -> Column:
    """The raw cells of a table row in either notation, empty ones too; what stands before the first bar is dropped."""
    # each step is told once, and only where a row has what it looks for
    flat = F.replace(F.when(row.contains("<"), F.regexp_replace(row, r"(?is)<ref[^>]*>.*?</ref>|<ref[^>]*/>", "")).otherwise(row), F.lit("||"), F.lit("\n|"))
    return F.slice(F.split(F.concat(F.lit("\n"), flat), r"\n\|", -1), 2, 1 << 30)


def score(text: Column) -> Column:
    """struct<home,away> of `N-N` at the start, after a shootout in parentheses too; null if there is none."""
    found = lambda k: F.regexp_extract(text, SCORE, k).try_cast("int")
    return F.when(text.rlike(SCORE), F.struct(found(1).alias("home"), found(2).alias("away")))


def shootout(raw: Column) -> Column:
    """struct<home,away>: exactly two small numbers in parentheses, else `pen ... N-N`; null if neither."""
    small = F.regexp_extract_all(raw, F.lit(r"(?i)(?:\{\{\s*small\s*\||<small>)\s*\((\d+)\)"), 1)
    written = r"(?i)pen[^\d]{0,20}(\d+)\s*[-:–—]\s*(\d+)"
    one = lambda k: F.regexp_extract(raw, written, k).try_cast("int")
    pair = F.struct(F.get(small, 0).try_cast("int").alias("home"), F.get(small, 1).try_cast("int").alias("away"))
    return F.when(F.size(small) == 2, pair).when(raw.rlike(written), F.struct(one(1).alias("home"), one(2).alias("away")))


def status(row: Column) -> Column:
    """suspended, desk or '': completed later wins over not finished, and that over a ruling."""
    return F.when(row.rlike("(?iu)" + COMPLETED), "").when(row.rlike("(?iu)" + UNFINISHED), "suspended").when(row.rlike("(?iu)" + DESK), "desk").otherwise("")


def unread_ruling(row: Column) -> Column:
    """The row speaks of a ruling, and status() could not tell what it did."""
    return ~row.rlike("(?iu)" + COMPLETED) & row.rlike("(?iu)" + RULING) & (status(row) == "")


def cross_group(label: Column) -> Column:
    """One spelling of the label of matches between groups."""
    return F.when(label.rlike("(?i)^interzonal"), "Interzonal").otherwise(label)


def is_round(label: Column) -> Column:
    return label.rlike(ROUND_TITLE)


def as_group(title: Column) -> Column:
    """A title as a group's name: '' for a round's title or that of standings."""
    return F.when(is_round(title) | title.rlike(r"(?i)^(tabla|posiciones|promedios)\b"), "").otherwise(title)


def capitalised(label: Column) -> Column:
    named = F.concat(F.upper(F.substring(label, 1, 1)), F.lower(F.substring(label, 2, 1 << 20)))
    return F.when(named == "Semifinal", "Semifinales").otherwise(named)


def normalized(name: Column) -> Column:
    """A name as it is compared: one kind of apostrophe, ASCII letters in lower case, dots as spaces, single spaces."""
    low = lowered(ascii_letters(F.translate(name, "`’´", "'''")))
    tight = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, r"\.", " "), r"\s*\(\s*", " ("), r"\s*\)", ")")
    return F.trim(F.regexp_replace(tight, r"\s+", " "))


def base_name(name: Column) -> Column:
    """A name without the parenthesis that tells it from its namesakes."""
    return normalized(F.regexp_replace(name, r"\s*\([^)]*\)\s*$", ""))


def core_name(name: Column) -> Column:
    """Letters and digits of a name outside of parentheses."""
    plain = lowered(ascii_letters(name))
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"\(.*?\)", " "), "[^a-z0-9 ]+", " "), " +", " "))


def confusable(a: Column, b: Column) -> Column:
    """Of two core names: they are equal, or one begins or ends with the other as whole words."""
    part = lambda x, y: x.startswith(F.concat(y, F.lit(" "))) | x.endswith(F.concat(F.lit(" "), y))
    return (a != "") & (b != "") & ((a == b) | part(a, b) | part(b, a))


def label_number(label: Column) -> Column:
    """The first run of digits, else 0."""
    digits = F.regexp_extract(label, r"(\d+)", 1)
    return F.coalesce(F.concat(F.lit("0"), digits).try_cast("int"), F.lit(0))


def round_name(label: Column) -> Column:
    """A round's label in the words of the ladder: synonyms, and without a number behind or a branch before it if a known round is left."""
    known = [*ROUNDS, *ROUND_SYNONYMS]
    same = F.create_map(*(F.lit(x) for kv in ROUND_SYNONYMS.items() for x in kv))
    named = lambda c: F.coalesce(same[c], c)
    low = F.trim(lowered(F.coalesce(label, F.lit(""))))
    bare, branch = F.regexp_replace(low, r"\s+\d+$", ""), F.regexp_replace(low, r"^.+?\s+-\s+", "")
    return F.when(bare.isin(known), named(bare)).when(branch.isin(known), named(branch)).otherwise(low)


def round_rank(name: Column) -> Column:
    """A round's place on the ladder from 0; null for what is not on it."""
    return F.nullif(F.array_position(F.lit(list(ROUNDS)), name), F.lit(0).cast("long")).cast("int") - 1


def winner(home: Column, away: Column, hs: Column, aws: Column, hpens: Column, apens: Column) -> Column:
    """By score, else by shootout; '' for a draw without one. An equal shootout counts for the away side."""
    return F.when(hs > aws, home).when(aws > hs, away).when(hpens.isNull(), "").when(hpens > apens, home).otherwise(away)


def source_page(source: Column) -> Column:
    """The page of a published row's source, without the credits that follow."""
    return F.substring_index(source, " + ", 1)


def pair_key(a: Column, b: Column) -> Column:
    """One key for two names in either order."""
    return F.concat(F.least(a, b), F.lit("\t"), F.greatest(a, b))
