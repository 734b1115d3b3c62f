"""From wikitext pages to rows, relationally: lines, headings, tables, templates, then matches, brackets and standings.

Pages are rows (page, text). Text is split into lines (or at template braces), positions are running sums, and what a
line belongs to (section, table, row, template) comes from windows over a page's lines. Only cells that fill several
rows need a fold, over the rows between two labels of a table (a matchday), which is a built-in aggregate too.

`about` tells of each page: (page, first_year, last_year, from_month, layout), layout being league or cup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchledger.functions import dates, text
from matchledger.functions.letters import lowered
from matchledger.operators.relational import by_page, once
from matchledger.schema import GROUPS, KNOCKOUT

Keep = Callable[[DataFrame, str], DataFrame]

# Fixed values of the pages' language.
STOP_TITLES = (
    "entrenadores", "goleadores", "goleadoras", "plantel", "planteles", "estadios", "vease tambien", "véase también", "referencias",
    "enlaces externos", "notas", "bibliografia", "bibliografía",
)
COLUMN_NAMES = (
    "local", "resultado", "visitante", "visita", "estadio", "fecha", "hora", "partido", "equipo 1", "equipo 2", "equipo", "arbitro", "árbitro", "ciudad",
)
MATCH_HEADERS = (("local", "resultado", "visitante"), ("local", "resultado", "visita"), ("equipo 1", "resultado", "equipo 2"))
ROUND_HEADING = (
    r"(?iu)^(Primera fase|Segunda fase|Tercera fase|Cuarta fase|Quinta fase|Primera ronda|Segunda ronda|Tercera ronda|Cuarta ronda|Primera instancia"
    r"|Segunda instancia|Tercera instancia|Cuarta instancia|Treintaidosavos|Dieciseisavos|Octavos|Cuartos|Semifinales|Semifinal|Final|Preclasificatorio|Ronda previa|Fase final I{1,2})"
)
RESULTS, STANDINGS_TITLE, AGGREGATE_TITLE = r"^Resultados$", "(?i)Tabla de posiciones", "(?i)descenso|promedio|anual|acumulad"
LABEL = r'!\s*colspan\s*=\s*"?\d+"?[^|\n]*\|\s*(.+)'
MATCHDAY, KNOCKOUT_STAGE = r"(?i)^fecha\s*\d+", "(?i)eliminatori"
STANDINGS_COLUMNS = ("pj", "pg", "pe", "pp", "gf", "gc")
LEVELS = range(1, 7)


def lines(pages: DataFrame) -> DataFrame:
    """(page, line_no, pos, line): pos is the offset of a line in its page."""
    each = by_page(pages.select("page", "text")).select("page", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    before = Window.partitionBy("page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("pos", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)).cast("long"))


def headings(ls: DataFrame) -> DataFrame:
    """(page, pos, level, title) of every heading."""
    pattern = r"^(=+)\s*([^=\n]+?)\s*=+\s*$"
    own = ls.where(F.col("line").rlike(pattern))
    return own.select("page", "pos", F.length(F.regexp_extract("line", pattern, 1)).alias("level"), text.clean(F.regexp_extract("line", pattern, 2)).alias("title"))


def outlined(ls: DataFrame) -> DataFrame:
    """Lines with level and title (of headings), under (array: for n from 1 the last title that counts, of a level below n), own_title (the last heading), results (start, level: the outermost section of results) and cup (start, title: the outermost section of a round)."""
    pattern = r"^(=+)\s*([^=\n]+?)\s*=+\s*$"
    got = once(ls, level=F.when(F.col("line").rlike(pattern), F.length(F.regexp_extract("line", pattern, 1))))
    got = once(got, title=F.when(F.col("level").isNotNull(), text.clean(F.regexp_extract("line", pattern, 2))))
    upto = Window.partitionBy("page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    is_head = F.col("level").isNotNull()
    named = F.when(is_head, F.when(~lowered(F.col("title")).isin(*STOP_TITLES), text.cross_group(F.col("title"))))
    mark = F.when(is_head, F.struct("pos", "level", F.col("title").rlike(RESULTS).alias("is_results"), F.col("title").rlike(ROUND_HEADING).alias("is_round"), "title"))
    got = once(got, named=named, mark=mark)
    named, mark = F.col("named"), F.col("mark")
    under = F.array(*(F.coalesce(F.last(F.when(F.col("level") < n, named), ignorenulls=True).over(upto), F.lit("")) for n in range(1, 8)))
    # the last heading of level n or above: where it is itself a section's title of level n, the line is inside of that section
    last = [F.last(F.when(F.col("level") <= n, mark), ignorenulls=True).over(upto).alias(f"h{n}") for n in LEVELS]
    got = got.select("*", under.alias("under"), F.last("title", ignorenulls=True).over(upto).alias("own_title"), *last)
    inside = lambda flag: F.coalesce(*(F.when((F.col(f"h{n}.level") == n) & F.col(f"h{n}.{flag}"), F.col(f"h{n}")) for n in LEVELS))
    results, cup = inside("is_results"), inside("is_round")
    return got.withColumn("results", results).withColumn("cup", cup).drop("named", "mark", *(f"h{n}" for n in LEVELS))


def asked(pages: DataFrame, about: DataFrame | None) -> DataFrame:
    """(page, line_no, pos, line, step, depth): the lines that some reader asks for, with what a line adds to the depth of tables, and the depth.

    These are headings, lines of tables, labels, standings in templates, and all lines since the first heading on their page
    that may open a section of results or, on pages of cups, of a round. Without `about`, any page may be either. Prose and
    templates of matches are most lines of some pages, and need neither an outline nor a place in a table."""
    line, level = F.col("line"), r"^(=+)\s*([^=\n]+?)\s*=+\s*$"
    dealt = by_page(pages.select("page", "text"))  # before a join, by which Spark would deal pages else, and merge the parts
    told = dealt.withColumn("layout", F.lit(None).cast("string")) if about is None else dealt.join(about.select("page", "layout"), "page", "left")
    each = told.select("page", "layout", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    upto = Window.partitionBy("page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    # a text is searched for an expression only if it begins like it
    step = F.when(line.contains("{|") & line.rlike(r"^\s*\{\|"), 1).when(line.startswith("|}"), -1).otherwise(0)
    is_head = line.startswith("=") & line.rlike(level)
    sections = F.when(F.col("layout").isNull(), f"{RESULTS}|{ROUND_HEADING}").when(F.col("layout") == "cup", ROUND_HEADING).otherwise(RESULTS)
    opens = F.when(is_head, F.rlike(text.clean(F.regexp_extract("line", level, 2)), sections))
    got = each.select(
        "page", "line_no", "line", (F.sum(F.length("line") + 1).over(upto) - F.length("line") - 1).cast("long").alias("pos"), F.sum(step).over(upto).alias("depth"), F.max(opens).over(upto).alias("since"),
        step.alias("step"), is_head.alias("is_head"),
    )
    in_template = line.contains("{{") & line.rlike(r"(?i)\{\{\s*Tabla de posiciones equipo")
    return got.where((F.col("depth") > 0) | (F.col("step") == -1) | F.col("is_head") | F.coalesce("since", F.lit(False)) | line.contains("!") | in_template).select("page", "line_no", "pos", "line", "step", "depth")


def tabled(ls: DataFrame) -> DataFrame:
    """Lines of asked() with table: a number for each outermost table of a page, null outside; tables that are never closed count as none."""
    upto = Window.partitionBy("page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    first = (F.col("step") == 1) & (F.col("depth") == 1)
    inside = (F.col("depth") > 0) | (F.col("step") == -1)
    got = ls.withColumn("table", F.when(inside, F.sum(first.cast("int")).over(upto)))
    whole = F.max((F.col("step") == -1) & (F.col("depth") == 0)).over(Window.partitionBy("page", "table"))
    return got.withColumn("table", F.when(whole, F.col("table"))).drop("step", "depth")


def table_rows(tabled_lines: DataFrame, block: Column) -> DataFrame:
    """(page, block, row_no, row, first: the row's first line with its context): the rows of each block. Rows end at row marks and where a table opens or closes."""
    context = F.struct("pos", "under", "results", "cup", "table")
    own = by_page(tabled_lines.select("page", block.alias("block"), "pos", "line", "title", context.alias("context")).where("block is not null"))
    ends = F.col("line").rlike(r"^\s*(\|-|\{\||\|\})")
    upto = Window.partitionBy("page", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("row_no", F.sum(ends.cast("int")).over(upto)).withColumn("line", F.when(ends, F.regexp_replace("line", r"^\s*(\|-+|\{\|.*|\|\})", "")).otherwise(F.col("line")))
    held = own.groupBy("page", "block", "row_no").agg(F.sort_array(F.collect_list(F.struct("pos", "line", "title"))).alias("ls"), F.min(F.struct("pos", F.col("context").alias("c"))).alias("c"))  # of a table's row
    row = F.array_join(F.transform("ls", lambda x: x["line"]), "\n")
    title = F.try_element_at(F.filter(F.transform("ls", lambda x: x["title"]), lambda t: t.isNotNull()), F.lit(-1))
    return held.select("page", "block", "row_no", row.alias("row"), F.when(F.size(F.filter(F.col("ls.title"), lambda t: t.isNotNull())) > 0, title).alias("title"), F.col("c.c.*"))


def labels(row: Column) -> Column:
    """The labels of a row's headers that span columns, without names of columns."""
    found = text.cleaned(F.regexp_extract_all(row, F.lit(LABEL), 1))
    return F.filter(found, lambda c: (c != "") & ~lowered(c).isin(*COLUMN_NAMES))


def filled(rows: DataFrame, columns: int) -> DataFrame:
    """rows with raw: array of `columns` cells, in which cells that fill several rows reach down to the next label, heading or block.

    A cell that reaches down takes its column, so the row's own cells move on to the next free ones: a column's cell is
    found by counting the free columns before it."""
    own = once(rows.where("not row rlike '^\\\\s*!'"), cells=text.row_cells(F.col("row"))).where("size(cells) >= 3")
    own = own.withColumn("spans", F.col("row").rlike("(?i)rowspan"))  # cells are asked for their span only where one is told
    rest = [c for c in own.columns if c not in ("page", "block", "carry", "row_no")]
    held = own.groupBy("page", "block", "carry").agg(F.sort_array(F.collect_list(F.struct("row_no", *rest))).alias("rs"))  # between two labels

    none = F.array_repeat(F.struct(F.lit(0).alias("left"), F.lit("").alias("cell")), columns)

    def step(state: Column, r: Column) -> Column:
        free = lambda p: p["left"] <= 0

        def column(p: Column, c: Column) -> Column:
            at = F.size(F.filter(F.slice(state["pend"], F.lit(1), c), free))  # free columns before this one
            own = F.get(r["cells"], at)
            span = F.when(own.isNotNull(), text.cell_span(own) - 1).otherwise(0)
            return F.when(free(p), F.struct(span.alias("left"), F.coalesce(own, F.lit("")).alias("cell"))).otherwise(F.struct((p["left"] - 1).alias("left"), p["cell"].alias("cell")))

        pend = F.transform(state["pend"], column)
        return F.struct(pend.alias("pend"), F.concat(state["done"], F.array(pend["cell"])).alias("done"))

    start = F.struct(none.alias("pend"), F.array().cast("array<array<string>>").alias("done"))
    # where no cell reaches down, each row has its own cells
    reaches = F.exists("rs", lambda r: r["spans"] & F.exists(r["cells"], lambda c: text.cell_span(c) > 1))
    alone = F.transform("rs", lambda r: F.transform(F.lit(list(range(columns))), lambda i: F.coalesce(F.get(r["cells"], i), F.lit(""))))
    told = once(held, raw=F.when(reaches, F.aggregate("rs", start, step, lambda s: s["done"])).otherwise(alone))
    each = told.select("page", "block", "carry", F.inline(F.arrays_zip(F.col("rs").alias("r"), F.col("raw"))))
    return each.select("page", "block", "carry", "r.*", "raw").drop("cells", "spans")


def _match(df: DataFrame, cols: dict[str, Column], *more: str) -> DataFrame:
    """The columns of working matches; '' or null for those that are not given."""
    base = {
        "date": F.lit(""), "time": F.lit(""), "hpens": F.lit(None).cast("int"), "apens": F.lit(None).cast("int"), "phase": F.lit(KNOCKOUT), "grp": F.lit(""), "matchday": F.lit(""),
        "section": F.lit(""), "venue": F.lit(""), "neutral": F.lit(None).cast("boolean"), "status": F.lit(""),
    } | cols
    order = ["page", "pos", "leg", "date", "time", "home", "away", "hs", "aws", "hpens", "apens", "phase", "grp", "matchday", "section", "venue", "neutral", "status", "row"]
    return df.select("page", F.col("pos"), base.pop("leg", F.lit(0)).alias("leg"), *(base.get(c, F.col(c) if c in df.columns else F.lit("")).alias(c) for c in order[3:]), *more)


def league_rows(rows: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """Matches of one-leg tables. rows: table_rows() with section, default_group, outside_league, qualifies (whether an
    ambiguous label is told with its section), kind and about's columns."""
    numbered = once(rows, label=F.when(F.col("row").contains("!"), F.try_element_at(labels(F.col("row")), F.lit(-1))))
    label = F.col("label")
    has = label.isNotNull()
    is_day = label.rlike(MATCHDAY) & ~F.col("outside_league")
    is_round = ~is_day & (F.col("outside_league") | text.is_round(label))
    numbered = numbered.withColumn("label_kind", F.when(has, F.when(is_day, "day").when(is_round, "round").otherwise("group")))
    numbered = numbered.withColumn("group_label", F.when(F.col("label_kind") == "group", text.cross_group(F.col("label"))))
    numbered = numbered.join(ambiguous.select("page", F.col("label").alias("group_label"), F.lit(True).alias("is_ambiguous")), ["page", "group_label"], "left")
    set_day = F.when(F.col("label_kind").isin("day", "round"), F.col("label")).when(F.col("title").isNotNull(), F.when(text.is_round(F.col("title")), F.col("title")).otherwise(""))
    set_round = F.when(F.col("label_kind") == "round", F.col("label")).when(F.col("label_kind").isin("day", "group"), "").when(text.is_round(F.col("title")), F.col("title"))
    qualified = F.when(F.col("is_ambiguous") & F.col("qualifies") & (F.col("section") != ""), F.concat("section", F.lit(" - "), "group_label")).otherwise(F.col("group_label"))
    header = F.col("row").rlike(r"^\s*!")
    set_neutral = F.when(header & F.col("row").rlike(r"(?i)\bequipos?\s*1\b"), True).when(header & F.col("row").rlike(r"(?i)\blocal\b"), False)
    upto = Window.partitionBy("page", "block").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    held = lambda c, default: F.coalesce(F.last(c, ignorenulls=True).over(upto), default)
    start = F.when(F.col("outside_league"), F.coalesce(F.nullif("default_group", F.lit("")), "section")).otherwise("")
    # dealt by page, as joins by other keys leave pages in few parts
    state = by_page(numbered).select(
        "page", "block", "pos", "row_no", "row", "kind", "section", "first_year", "last_year", "from_month", held(set_day, start).alias("matchday"), held(set_round, start).alias("round"), held(qualified, F.col("default_group")).alias("group"), held(set_neutral, F.lit(False)).alias("neutral_table"),
        F.sum((F.col("label_kind").isNotNull() | F.col("title").isNotNull()).cast("int")).over(upto).alias("carry"),
    )
    full = once(filled(state, 6), cells=text.cell_texts(F.col("raw")))
    raw = lambda i: F.get("cells", i)
    got = once(full, home=raw(0), score=text.score(raw(1)), away=raw(2)).where("score is not null and home <> '' and away <> ''")
    got = once(got, pens=text.shootout(F.get("raw", 1)))
    season = F.col("first_year"), F.col("last_year"), F.col("from_month")
    got = once(got, day=raw(4), note=dates.played_on(F.col("row")))
    got = once(got, scheduled=dates.iso_date(F.col("day"), *season), noted=F.when(F.col("note") != "", dates.iso_date(F.col("note"), *season)).otherwise(""))
    date = F.when(F.col("noted") != "", dates.not_before(F.col("noted"), F.col("scheduled"))).otherwise(F.col("scheduled"))
    in_round = F.col("round") != ""
    return _match(got, {
        "date": date, "time": raw(5), "hs": F.col("score.home"), "aws": F.col("score.away"), "hpens": F.col("pens.home"), "apens": F.col("pens.away"),
        "phase": F.when(in_round, KNOCKOUT).otherwise(GROUPS), "grp": F.when(in_round, "").otherwise(F.col("group")), "matchday": F.col("matchday"), "section": F.col("section"),
        "venue": raw(3), "neutral": F.when(F.col("neutral_table"), True), "status": text.status(F.col("row")), "row": F.col("row"),
    }, "kind")


def ambiguous_labels(outline: DataFrame) -> DataFrame:
    """(page, label): labels of groups that stand under more than one level-2 section."""
    each = outline.where(F.col("line").rlike(LABEL)).select("page", F.get("under", 2).alias("section"), F.explode(labels(F.col("line"))).alias("label")).where(~(F.col("label").rlike(MATCHDAY) | text.is_round(F.col("label"))))
    named = each.select("page", "section", text.as_group(text.cross_group(F.col("label"))).alias("label")).where("label <> ''")
    return named.groupBy("page", "label").agg(F.count_distinct("section").alias("n")).where("n > 1").select("page", "label")


def two_leg_rows(rows: DataFrame, captions: DataFrame) -> DataFrame:
    """Two matches of each row of tables that name a column for either leg's home side. captions: (page, block, caption, columns array<string> in order)."""
    known = captions.withColumn("at", F.transform(F.lit(["local - ida", "local - vuelta", "ida", "vuelta"]), lambda c: F.array_position("columns", c).cast("int") - 1))
    own = rows.join(known.where("at[0] >= 0 and at[1] >= 0"), ["page", "block"])
    own = once(own.where("not row rlike '^\\\\s*!'"), cells=text.row_cells(F.col("row"))).where("size(cells) > array_max(transform(columns, (c, i) -> i))")
    own = once(own, told_cells=text.cell_texts(F.col("cells"))).drop("cells").withColumnRenamed("told_cells", "cells")
    get = lambda k: F.when(F.col("at")[k] >= 0, F.get("cells", F.col("at")[k])).otherwise("")
    own = once(own, leg_days=dates.leg_days(F.col("caption")))
    both = once(own, a=get(0), b=get(1), left=F.get("cells", F.least(F.col("at")[0], F.col("at")[1])), days=dates.two_days(F.col("leg_days"), F.col("first_year"), F.col("last_year"), F.col("from_month")))
    leg = lambda k, home, away, score, day: F.struct(F.lit(k).alias("leg"), F.col(home).alias("home"), F.col(away).alias("away"), F.regexp_replace(score, r"(?U)\s+", "").alias("told"), F.col(f"days.{day}").alias("date"))
    each = both.withColumn("m", F.explode(F.array(leg(0, "a", "b", get(2), "one"), leg(1, "b", "a", get(3), "two")))).select("*", "m.leg", "m.home", "m.away", "m.told", F.col("m.date").alias("date"))
    pattern = r"^(\d+)(?:\((\d+)\))?[-–](\d+)(?:\((\d+)\))?$"
    each = each.where(F.col("told").rlike(pattern) & (F.col("home") != "") & (F.col("away") != ""))
    n = lambda k: F.regexp_extract("told", pattern, k).try_cast("int")
    crossed = F.col("home") != F.col("left")  # the score stands in the order of the columns
    pick = lambda x, y: F.when(crossed, y).otherwise(x)
    round_ = F.trim(F.regexp_replace(F.regexp_replace(F.col("caption"), r"(?iu)\b\d{1,2}(\s*(,|y|al)\s*\d{1,2})*\s*de\s+[a-záéíóúñ]+|\b\d{1,2}\s*/\s*\d{1,2}\b", ""), r"(?i)(\s|[-–,]|\by\b|\bal\b)+$", ""))
    return _match(each, {"leg": F.col("leg"), "date": F.col("date"), "hs": pick(n(1), n(3)), "aws": pick(n(3), n(1)), "hpens": pick(n(2), n(4)), "apens": pick(n(4), n(2)), "matchday": round_, "section": F.col("section"), "row": F.col("row")})


def cup_rows(rows: DataFrame) -> DataFrame:
    """Matches of cup tables (date, venue, home, score, away) in sections of rounds."""
    own = once(rows.where("not row rlike '^\\\\s*!'"), cells=text.row_cells(F.col("row"))).where("size(cells) >= 5")
    own = once(own, told=text.cell_texts(F.slice("cells", 1, 5)))
    raw = lambda i: F.get("told", i)
    got = once(own, home=raw(2), score=text.score(raw(3)), away=raw(4)).where("score is not null and home <> '' and away <> ''")
    got = once(got, pens=text.shootout(F.get("cells", 3)))
    name = text.capitalised(F.regexp_extract("cup.title", ROUND_HEADING, 1))
    return _match(got, {"date": dates.iso_date(raw(0), F.col("first_year"), F.col("last_year"), F.col("from_month")), "venue": raw(1), "hs": F.col("score.home"), "aws": F.col("score.away"), "hpens": F.col("pens.home"), "apens": F.col("pens.away"), "matchday": name, "row": F.col("row")})


#: A template with templates in it, none of which holds another: most are like this. What stands in it is the first group. Three
#: braces in a row are left to the fold, by which the last two of them count.
SIMPLE = r"^\{\{((?:[^{}]++|\{\{[^{}]*+\}\}(?!\}))*+)\}\}(?!\})"


def _inside(template: Column) -> Column:
    """What stands in a template that a text begins with, up to the braces that close it; null if none do. The text is cut at
    braces, and a fold counts how deep a piece is; a brace behind another brace is a piece of one character that belongs to it."""
    pieces = F.filter(F.split(template, r"(?=\{\{|\}\})", -1), lambda p: p != "")

    def step(state: Column, p: Column) -> Column:
        depth = state["depth"] + F.when(p.startswith("{{"), 1).when(p.startswith("}}"), -1).otherwise(0)
        on = F.struct(depth.alias("depth"), (state["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"), (depth <= 0).alias("closed"))
        return F.when(state["closed"], state).otherwise(on)

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("closed"))
    folded = F.transform(F.array(pieces), lambda ps: F.aggregate(ps, start, step, lambda s: F.when(s["closed"], F.array_join(F.slice(ps, 1, s["n"]), ""))))
    return F.when(template.rlike(SIMPLE), F.regexp_extract(template, SIMPLE, 1)).otherwise(F.regexp_replace(F.get(folded, 0), r"^\{\{", ""))


def templates(pages: DataFrame, opener: str, about: DataFrame | None = None) -> DataFrame:
    """(page, pos, body, and the columns of `about`, whose pages only are read): the templates that begin with a pattern, up to the braces that close them; unclosed ones are left out, and what another one begins in counts for that one. The text is cut where one begins, so each is read by itself."""
    begins = r"\{\{\s*(?:" + opener + ")"
    dealt = by_page(pages.select("page", "text"))
    told, more = (dealt, []) if about is None else (dealt.join(about, "page"), [c for c in about.columns if c != "page"])
    cut = told.select("page", *more, F.posexplode(F.split("text", f"(?i)(?={begins})", -1)).alias("k", "chunk"))
    before = Window.partitionBy("page").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    own = cut.select("page", *more, "k", "chunk", F.coalesce(F.sum(F.length("chunk")).over(before), F.lit(0)).alias("pos")).where(F.col("chunk").startswith("{{") & F.col("chunk").rlike("(?i)^" + begins))
    return once(own, body=_inside(F.col("chunk"))).where("body is not null").select("page", "pos", "body", *more)


#: What is read of templates of matches.
MATCH_FIELDS = ("local", "visita", "resultado", "resultado penalti", "fecha", "estadio")


def template_rows(pages: DataFrame, outline: DataFrame, about: DataFrame) -> DataFrame:
    """Matches of match templates of league pages; half-time in parentheses is no shootout. The round is the last round's title of the same level-2 section."""
    years = ("first_year", "last_year", "from_month")
    found = templates(pages, r"Partidos?\s*\n", about.where("layout = 'league'").select("page", *years))
    key = lambda s: lowered(F.trim(F.regexp_replace(F.substring_index(s, "=", 1), r"^\|+|[\s]+$", "")))
    value = lambda s: F.trim(F.substr(s, F.length(F.substring_index(s, "=", 1)) + 2))
    pairs = F.transform(F.filter(F.split("body", r"\n\s*\|"), lambda s: s.contains("=")), lambda s: F.struct(key(s).alias("key"), value(s).alias("value")))
    got = once(found, fields=F.reverse(F.filter(pairs, lambda f: f["key"].isin(*MATCH_FIELDS))))  # the last of a name counts
    got = once(got, keys=F.col("fields.key"), raw=F.col("fields.value"), told=text.cleaned(F.col("fields.value")))
    of = lambda values, name: F.coalesce(F.get(values, (F.array_position("keys", name) - 1).cast("int")), F.lit(""))
    # steps without lambdas are by themselves, as Spark compiles those only
    f = lambda name: of("told", name)
    got = once(got, home=f("local"), away=f("visita"), goals=f("resultado"), shootout=f("resultado penalti"), day=f("fecha"), venue=f("estadio"), raw_day=of("raw", "fecha"))
    got = once(got, score=text.score(F.col("goals"))).where("score is not null")
    got = once(got, pens=text.score(F.col("shootout")))
    # the raw day is read as it is, too
    got = once(got, in_template=dates.template_date(F.col("raw_day")))
    got = got.withColumn("row", F.struct("score", "pens", "home", "away", "day", "in_template", "venue", "body", *years))
    # templates and headings in one order: templates carry their rows along, as a join would read them twice
    heads = outline.where("level is not null").select("page", "pos", "level", "title", F.lit(0).alias("kind"))
    marks = heads.unionByName(got.select("page", "pos", "row", F.lit(1).alias("kind")), allowMissingColumns=True)
    upto = Window.partitionBy("page").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    named = F.when(F.col("title").rlike(ROUND_HEADING), text.capitalised(F.regexp_extract("title", ROUND_HEADING, 1)))
    counted = F.when((F.col("level") < 3) & ~lowered(F.col("title")).isin(*STOP_TITLES), text.cross_group(F.col("title")))
    held = marks.select("*", F.last(F.when(named.isNotNull(), F.struct("pos", named.alias("name"))), ignorenulls=True).over(upto).alias("r"), F.last(F.when(F.col("level") <= 2, F.col("pos")), ignorenulls=True).over(upto).alias("since"), F.last(counted, ignorenulls=True).over(upto).alias("ctx")).where("kind = 1")
    got = held.select("page", "pos", F.coalesce(F.when(F.col("r.pos") >= F.coalesce("since", F.lit(0)), F.col("r.name")), F.lit("")).alias("round"), F.coalesce("ctx", F.lit("")).alias("ctx"), "row.*")
    in_template = F.col("in_template")
    date = F.when(in_template != "", in_template).otherwise(dates.iso_date(F.col("day"), F.col("first_year"), F.col("last_year"), F.col("from_month")))
    return _match(got, {"date": date, "hs": F.col("score.home"), "aws": F.col("score.away"), "hpens": F.col("pens.home"), "apens": F.col("pens.away"), "matchday": F.col("round"), "section": F.col("ctx"), "venue": F.col("venue"), "row": F.col("body")})


def captions(tabled_lines: DataFrame, block: Column) -> DataFrame:
    """(page, block, caption, columns, headers, labelled, title): what a table's header lines say, and the title before it."""
    own = tabled_lines.withColumn("block", block).where("block is not null")
    leg = r"(?i)^!\s*(?:[^|\n]*\|)?\s*(Local\s*-\s*(?:Ida|Vuelta)|Ida|Vuelta|Global)\s*$"
    column = F.when(F.col("line").rlike(leg), F.struct("pos", lowered(F.regexp_replace(F.regexp_extract("line", leg, 1), r"\s+", " ")).alias("name")))
    heads = F.when(F.col("line").rlike("^!"), F.transform(text.cell_texts(F.split(F.regexp_replace("line", "^!", ""), "!!")), lowered))
    got = own.groupBy("page", "block").agg(
        F.max(F.when(F.col("line").rlike(r"^\|\+"), F.regexp_extract("line", r"'''\s*(.*?)\s*'''", 1))).alias("caption"), F.array_sort(F.collect_list(column)).alias("cs"),
        F.flatten(F.collect_list(heads)).alias("headers"), F.bool_or(F.exists(labels(F.col("line")), lambda c: c.rlike(MATCHDAY))).alias("labelled"),
        F.min(F.struct("pos", F.coalesce("own_title", F.lit("")).alias("t"))).alias("first"),
    )
    return got.select("page", "block", F.coalesce("caption", F.lit("")).alias("caption"), F.array_distinct(F.transform("cs", lambda c: c["name"])).alias("columns"), "headers", "labelled", F.col("first.t").alias("title"))


def outline_of(pages: DataFrame, about: DataFrame | None = None) -> DataFrame:
    """Lines that readers ask for, with what they belong to; write it once where several readers use it. Tables come first, as
    lines are sorted for them while they are narrow. about (page, layout) spares lines that only pages of the other layout need."""
    return outlined(tabled(asked(pages, about)))


def matches(pages: DataFrame, about: DataFrame, keep: Keep = lambda df, name: df, outline: DataFrame | None = None) -> DataFrame:
    """All matches of the pages, in the columns of working rows but for competition and season; row_id is page, place and leg.

    League pages: sections of results, tables outside of them (two-leg ones first; else those whose header is that of
    matches), and match templates. A row from a table outside is left out if the page already has it. Cup pages: the
    tables in sections of rounds. keep may write the lines with what they belong to as a table, which is read often;
    outline is that table where there is one."""
    told = about.select("page", "first_year", "last_year", "from_month", "layout")
    outline = keep(outline_of(pages, told), "outline") if outline is None else outline
    wide = outline.join(told.select("page", "layout"), "page")
    league = wide.where("layout = 'league'")

    # a block is a section of results or a table outside of them
    in_results = F.col("results").isNotNull()
    block = F.when(in_results, F.concat(F.lit("r"), F.col("results.pos"))).when(F.col("table").isNotNull(), F.concat(F.lit("t"), F.col("table")))
    heads = captions(league, block)
    is_leg = F.array_contains("columns", "local - ida") & F.array_contains("columns", "local - vuelta")
    is_match = F.lit(False)
    for asked in MATCH_HEADERS:
        is_match = is_match | (F.size(F.array_except(F.lit(list(asked)), "headers")) == 0)
    shape = heads.select("page", "block", "caption", "columns", "labelled", is_leg.alias("is_leg"), is_match.alias("is_match"))
    rows = table_rows(league, block).join(told, "page").join(shape, ["page", "block"]).withColumn("kind", F.when(F.col("results").isNotNull(), 0).otherwise(1))
    inside = F.col("kind") == 0

    parent = F.get("under", F.col("results.level") - 1)
    stage = F.when(inside, F.get("under", F.least(F.col("results.level"), F.lit(3)) - 1)).otherwise(F.get("under", 2))
    rows = rows.withColumn("section", stage).withColumn("default_group", F.when(inside, text.as_group(parent)).otherwise(""))
    no_league = F.when(inside, text.is_round(parent) & ~F.col("labelled")).otherwise(~F.col("labelled") | text.is_round(F.col("section")))
    rows = rows.withColumn("outside_league", no_league | F.col("section").rlike(KNOCKOUT_STAGE)).withColumn("qualifies", inside)
    single = league_rows(rows.where("kind = 0 or (not is_leg and is_match)"), ambiguous_labels(league))
    legs = two_leg_rows(rows.where("kind = 1 and is_leg").drop("columns", "caption"), shape.where("is_leg").select("page", "block", "caption", "columns")).withColumn("kind", F.lit(1))
    by_template = template_rows(pages, outline, told).withColumn("kind", F.lit(2))

    key = ["page", "date", "home", "away", "hs", "aws"]
    every = by_page(single.unionByName(legs).unionByName(by_template))
    # a row from a table outside stays only if it is the first of its key and no other reader has the key
    seen = Window.partitionBy(*key)
    ranked = every.withColumn("has_sure", F.max(F.col("kind") != 1).over(seen)).withColumn("nth", F.row_number().over(seen.orderBy("kind", "pos", "leg")))
    kept = ranked.where("kind <> 1 or (not has_sure and nth = 1)").drop("has_sure", "nth")

    in_cup = F.when(F.col("cup").isNotNull(), F.concat(F.lit("c"), F.col("cup.pos")))
    cup = cup_rows(table_rows(wide.where("layout = 'cup'"), in_cup).join(told, "page")).withColumn("kind", F.lit(0))
    return kept.unionByName(cup).withColumn("row_id", F.format_string("%s#%d-%08d-%d", "page", F.when(F.col("kind") == 2, 1).otherwise(0), "pos", "leg")).drop("kind", "pos", "leg")


def links(pages: DataFrame) -> DataFrame:
    """(page, article, visible) of every link that shows another text than its target."""
    pattern = r"\[\[([^\]|]+)\|([^\]]+)\]\]"
    each = pages.select("page", F.explode(F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), 1).alias("a"), F.regexp_extract_all("text", F.lit(pattern), 2).alias("v"))).alias("x"))
    return each.select("page", F.trim("x.a").alias("article"), text.clean(F.col("x.v")).alias("visible"))


def bracket_bodies(pages: DataFrame) -> DataFrame:
    return templates(pages, r"(?:Copa|Cuadro|Llave)[^\n|}]*")


def bracket_slots(pages: DataFrame, bodies: DataFrame | None = None) -> DataFrame:
    """(page, pos, rd, slot, name, article): the clubs of brackets; places without a club, marks and walkovers are left out."""
    pattern = r"RD(\d+)-(?:team|equipo)(\d+)\s*=\s*((?:\[\[[^\]]*\]\]|[^\n|}])*)"
    every = [F.regexp_extract_all("body", F.lit(pattern), k) for k in (1, 2, 3)]
    each = (bracket_bodies(pages) if bodies is None else bodies).select("page", "pos", F.explode(F.arrays_zip(*(c.alias(n) for c, n in zip(every, ("rd", "slot", "raw"), strict=True)))).alias("x"))
    raw = F.col("x.raw")
    link = r"\[\[\s*([^\]|#]+?)\s*(?:\|([^\]]*))?\]\]"
    shown = F.coalesce(F.nullif(F.regexp_extract(raw, link, 2), F.lit("")), F.nullif(F.regexp_extract(raw, link, 1), F.lit("")), raw)
    name = F.trim(F.regexp_replace(F.regexp_replace(text.clean(F.col("shown")), r"\{\{.*", ""), r"^\s*\d+\s*:\s*", ""))
    got = once(once(each, shown=shown), name=name, article=F.regexp_extract(raw, link, 1), rd=F.col("x.rd").cast("int"), slot=F.col("x.slot").cast("int"))
    got = got.select("page", "pos", "rd", "slot", "name", "article")
    return got.where(~F.col("name").rlike(r"(?i)^(w/?o|p\.?|libre|bye|[\d\s.:-]*)$") & ~F.col("article").isin("Tiros desde el punto penal", "Prórroga (deporte)"))


def bracket_legs(pages: DataFrame, bodies: DataFrame | None = None) -> DataFrame:
    """(page, one, one_article, two, two_article, leg, a, b): scores of ties; a third number that is the sum of two legs is none."""
    pattern = r"RD(\d+)-(?:score|goles)(\d+)(?:-(\d+)|(ida|vuelta))?\s*=\s*([^\n|}]*)"
    every = [F.regexp_extract_all("body", F.lit(pattern), k).alias(f"g{k}") for k in range(1, 6)]
    each = (bracket_bodies(pages) if bodies is None else bodies).select("page", "pos", F.explode(F.arrays_zip(*every)).alias("x")).select("page", "pos", "x.*")
    leg = F.when(F.col("g3") != "", F.col("g3").try_cast("int")).when(F.lower("g4") == "vuelta", 2).otherwise(1)
    told = F.regexp_replace(text.clean(F.col("g5")), r"^\(|\)$", "")
    goals = once(each, rd=F.col("g1").cast("int"), slot=F.col("g2").cast("int"), leg=leg, n=told.try_cast("int")).where("n is not null").groupBy("page", "pos", "rd", "slot", "leg").agg(F.max("n").alias("n"))
    upper = goals.where("slot % 2 = 1").withColumnRenamed("n", "a")
    lower = goals.where("slot % 2 = 0").select("page", "pos", "rd", (F.col("slot") - 1).alias("slot"), "leg", F.col("n").alias("b"))
    tie = ["page", "pos", "rd", "slot"]
    legs_ = upper.join(lower, [*tie, "leg"])
    w = Window.partitionBy(*tie)
    order = w.orderBy("leg")
    marked = legs_.withColumn("k", F.row_number().over(order)).withColumn("of", F.count("*").over(w))
    for c in ("a", "b"):
        marked = marked.withColumn(f"sum_{c}", F.sum(c).over(order.rowsBetween(-2, -1)))
    kept = marked.where(~((F.col("of") == 3) & (F.col("k") == 3) & (F.col("a") == F.col("sum_a")) & (F.col("b") == F.col("sum_b"))))
    slots = bracket_slots(pages, bodies)
    one = slots.where("slot % 2 = 1").select(*tie, F.col("name").alias("one"), F.col("article").alias("one_article"))
    two = slots.where("slot % 2 = 0").select("page", "pos", "rd", (F.col("slot") - 1).alias("slot"), F.col("name").alias("two"), F.col("article").alias("two_article"))
    return kept.join(one, tie).join(two, tie).select("page", "one", "one_article", "two", "two_article", F.col("k").alias("leg"), "a", "b")


def all_rows(pages: DataFrame, outline: DataFrame | None = None) -> DataFrame:
    """(page, pos, row) of every table's rows."""
    return table_rows(outline_of(pages) if outline is None else outline, F.col("table").cast("string")).select("page", "pos", "row")


def _with_cells(rows: DataFrame) -> DataFrame:
    raw = once(rows.select("page", "pos", "row"), raw=text.row_cells(F.col("row"))).where("size(raw) >= 3")
    return once(raw, cells=text.cell_texts(F.col("raw")))


def voided(rows: DataFrame) -> DataFrame:
    """(page, home, away): matches that are lost for both, which no score can tell."""
    # only rows in which the letters stand, whatever is between them, are cut into cells
    likely = rows.where(F.col("row").rlike(r"(?i)^[^p]*+p[^p]*+p[^-]*+-[^p]*+p[^p]*+p"))
    each = _with_cells(likely).select("page", "cells", F.posexplode("cells").alias("i", "cell")).where(F.col("cell").rlike(r"(?i)^\s*PP\s*-\s*PP\s*$") & F.col("i").between(1, F.size("cells") - 2))
    return each.select("page", F.get("cells", F.col("i") - 1).alias("home"), F.get("cells", F.col("i") + 1).alias("away")).distinct()


def unread_rulings(rows: DataFrame) -> DataFrame:
    """(page, home, told, away): scored rows that speak of a ruling which status() could not read."""
    own = _with_cells(rows).where(text.score(F.get("cells", 1)).isNotNull() & text.unread_ruling(F.col("row")))
    return own.select("page", F.get("cells", 0).alias("home"), F.get("cells", 1).alias("told"), F.get("cells", 2).alias("away")).distinct()


def contradicted_highlights(rows: DataFrame) -> DataFrame:
    """(page, home, away, hs, aws, says): rows of which exactly one of home, score and away is highlighted, against the score. Rows with notes or shootouts say nothing."""
    blue_cell = r"""(?i)bgcolor\s*=\s*["']?#?(?:d0e7ff|doe7ff)\b"""
    raw = rows.where(~F.col("row").rlike(r"(?i)<ref|\{\{\s*refn") & F.col("row").rlike(blue_cell))  # rows without a highlight say nothing
    raw = once(raw.select("page", "row"), cells=text.row_cells(F.col("row"))).where("size(cells) >= 3")
    raw = once(raw, told=text.cell_texts(F.col("cells")))
    plain, shootout = r"^\s*(\d+)\s*-\s*(\d+)\s*$", r"(?i)\{\{\s*small|\bpen\.|\(\d+\)"
    is_score = lambda k: F.get("told", k).rlike(plain) | F.get("cells", k).rlike(shootout)
    got = once(raw, k=F.get(F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("cells") - 2)), is_score), 0)).where("k is not null")
    cell = lambda d: F.get("cells", F.col("k") + d)
    blue = [cell(d).rlike(blue_cell).cast("int") for d in (-1, 0, 1)]
    goal = lambda k: F.regexp_extract("score", plain, k).try_cast("int")
    got = once(got, home=F.get("told", F.col("k") - 1), score=F.get("told", F.col("k")), away=F.get("told", F.col("k") + 1), decided=cell(0).rlike(shootout), **{f"b{i}": c for i, c in enumerate(blue)})
    got = got.where("b0 + b1 + b2 = 1 and not decided").where(F.col("score").rlike(plain)).select("page", "home", "away", goal(1).alias("hs"), goal(2).alias("aws"), F.expr("CASE WHEN b0 = 1 THEN 'home' WHEN b1 = 1 THEN 'draw' ELSE 'away' END").alias("says"))
    return got.where("says <> CASE WHEN hs > aws THEN 'home' WHEN aws > hs THEN 'away' ELSE 'draw' END").distinct()


def standings(pages: DataFrame, outline: DataFrame | None = None, keep: Keep = lambda df, name: df) -> DataFrame:
    """(page, pos, seq, club, article, pj, gf, gc, g, e, p, pts, diff, closes): rows of standings in both notations: templates under a title of standings, and tables whose header names the columns, but for aggregates of several seasons. closes says whether a table's row agrees with itself; diff is null for templates, which cannot be checked. outline and keep are as for matches()."""
    outline = keep(outline_of(pages), "outline") if outline is None else outline
    pattern = r"(?is)\{\{\s*Tabla de posiciones equipo\s*\|(.*?)\}\}"
    rows = once(outline.where(F.coalesce("own_title", F.lit("")).rlike(STANDINGS_TITLE)).select("page", "pos", "line"), body=F.regexp_extract("line", pattern, 1)).where("body <> ''")
    number = lambda k: F.regexp_extract("body", rf"(?<![a-zA-Z]){k}\s*=\s*(\d+)", 1).try_cast("int")
    link = r"\[\[\s*([^\]|]+?)\s*(?:\|([^\]]*))?\]\]"
    has_link = lambda c: c.rlike(link)
    name = lambda c: text.clean(F.when(has_link(c), F.coalesce(F.nullif(F.regexp_extract(c, link, 2), F.lit("")), F.regexp_extract(c, link, 1))).otherwise(F.regexp_replace(c, r"(?s)(\{\{|<ref).*", "")))
    none = F.lit(None).cast("int")
    rows = once(rows, shown=F.regexp_extract("body", r"(?<![a-zA-Z])eq\s*=\s*(.*?)(?:\|\s*#?\s*color\s*=|$)", 1), gf=number("gf"), gc=number("gc"), g=number("g"), e=number("e"), p=number("p"))
    rows = once(rows.withColumn("pj", F.col("g") + F.col("e") + F.col("p")).where("pj is not null and gf is not null and gc is not null"), club=name(F.col("shown")), article=F.regexp_extract("shown", link, 1))
    cols = ["page", "pos", "club", "article", "pj", "gf", "gc", "g", "e", "p", "pts", "diff"]
    by_template = rows.withColumn("pts", none).withColumn("diff", none).select(*cols)

    # the rows of tables of standings only
    block = F.col("table").cast("string")
    heads = captions(outline, block).where((F.size(F.array_except(F.lit(list(STANDINGS_COLUMNS)), "headers")) == 0) & ~F.exists("headers", lambda h: h.contains("prom")))
    asked = heads.where(~F.col("title").rlike(AGGREGATE_TITLE)).select("page", F.col("block").cast("long").alias("table"))
    own = table_rows(outline.join(asked, ["page", "table"], "left_semi"), block)
    cells = once(own.select("page", "pos", "row"), raw=F.filter(text.row_cells(F.col("row")), lambda c: F.trim(c) != "")).where("size(raw) > 0")
    cells = once(cells, cells=text.cell_texts(F.col("raw")))
    names = F.filter(F.sequence(F.lit(0), F.size("cells") - 1), lambda i: F.get("cells", i).rlike(r"[A-Za-zÁ-ú]{3}") & ~F.get("cells", i).contains("="))
    sized = once(cells, ns=F.filter("cells", lambda c: c.rlike(r"^[-+]?\d+$")), at=F.try_element_at(names, F.lit(-1))).where("size(ns) >= 8 and at is not null")
    n = lambda k: F.try_element_at("ns", F.lit(k - 8)).try_cast("int")
    sized = once(sized, told=F.get("raw", F.col("at")), shown=F.get("cells", F.col("at")))
    linked = has_link(F.col("told"))
    by_table = once(sized, club=F.when(linked, name(F.col("told"))).otherwise(F.col("shown")), article=F.regexp_extract("told", link, 1), pj=n(1), gf=n(5), gc=n(6), g=n(2), e=n(3), p=n(4), pts=n(0), diff=n(7)).select(*cols)
    ok = F.col("diff").isNull() | ((F.col("gf") - F.col("gc") == F.col("diff")) & (F.col("g") + F.col("e") + F.col("p") == F.col("pj")))
    both = by_template.union(by_table).where("club <> ''")
    return both.withColumn("closes", ok).withColumn("seq", F.col("pos"))
