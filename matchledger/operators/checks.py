"""Invariant checks: each takes matches and returns findings (page, check, severe, subject, detail).

Every check is grouping, joins and windows by page and finer keys, so pages spread over the cluster; none collects
rows. Lists in `detail` hold at most a few names; they are cut with row_number(), which Spark cuts before it shuffles.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchledger.functions.dates import day_number
from matchledger.functions.text import label_number, pair_key, round_name, round_rank, winner
from matchledger.schema import GROUP, GROUPS, KNOCKOUT, MOST_GOALS, STAGE_GROUP
from matchledger.sinks.shared import cut


def text(*parts: Column | str) -> Column:
    """Columns and literals as one text."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def finding(df: DataFrame, check: str, severe: bool, subject: Column, detail: Column | None = None) -> DataFrame:
    return df.select("page", F.lit(check).alias("check"), F.lit(severe).alias("severe"), subject.alias("subject"), (F.lit("") if detail is None else detail).alias("detail"))


def sides(m: DataFrame, *more: str) -> DataFrame:
    """A row for each club of a match: club, rival, gf, gc, at_home and the columns named."""
    side = lambda a, b, x, y, home: F.struct(F.col(a).alias("club"), F.col(b).alias("rival"), F.col(x).alias("gf"), F.col(y).alias("gc"), F.lit(home).alias("at_home"))
    if "hs" not in m.columns:  # folded matches tell no score
        m = m.withColumns({k: F.lit(None).cast("int") for k in ("hs", "aws")})
    return m.select("page", *more, F.inline(F.array(side("home", "away", "hs", "aws", True), side("away", "home", "aws", "hs", False))))


def played(m: DataFrame, when: Column | None = None) -> Column:
    """How many matches rows stand for, or those of them for which `when` holds: folded() says it in `times`, else each row is one."""
    each = F.col("times") if "times" in m.columns else F.lit(1)
    return F.sum(each if when is None else F.when(when, each).otherwise(0))


def times(m: DataFrame) -> list[str]:
    return ["times"] if "times" in m.columns else []


def sample(df: DataFrame, keys: list[str], order: list[str], n: int, shown: Column) -> DataFrame:
    """keys, total, shown: the first n of each group in this order, joined; how many there are."""
    total = df.groupBy(*keys).agg(F.count("*").alias("total"))
    top = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)
    listed = top.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", shown.alias("x")))), lambda s: s["x"]), ", ").alias("shown"))
    return total.join(listed, keys)


def completeness(m: DataFrame) -> DataFrame:
    """Matches without a club or a score, and with scores beyond belief."""
    subject = F.col("row_id")
    clubs = finding(m.where("home = '' or away = ''"), "no_club", True, subject)
    none = finding(m.where("hs is null or aws is null"), "no_score", True, subject)
    odd = finding(m.where(~(F.col("hs").between(0, MOST_GOALS) & F.col("aws").between(0, MOST_GOALS))), "odd_score", True, subject, text(F.col("hs"), "-", F.col("aws")))
    return clubs.union(none).union(odd)


def undated(m: DataFrame) -> DataFrame:
    got = sample(m.where("date = ''").withColumn("shown_id", F.col("row_id")), ["page"], ["row_id"], 3, F.col("shown_id"))
    return finding(got, "undated", False, text(F.col("total")), F.col("shown"))


def unknown_names(m: DataFrame, known: DataFrame) -> DataFrame:
    """known: (name). Clubs that no registry entry has."""
    names = sides(m).where("club <> ''").select("page", F.col("club").alias("name")).distinct()
    got = sample(names.join(known.select("name").distinct(), "name", "left_anti"), ["page"], ["name"], 6, F.col("name"))
    return finding(got, "unknown_club", True, text(F.col("total")), F.col("shown"))


def shootouts(m: DataFrame) -> DataFrame:
    """A shootout of a match that was no draw, unless it decided a series of exactly two legs that is level on aggregate."""
    # series are summed up, and only shootouts that were no draw look them up
    series = [*(F.col(k) for k in ("page", "section", "matchday")), pair_key(F.col("home"), F.col("away")).alias("__pair")]
    first = F.least("home", "away")
    a = F.sum(F.when(F.col("home") == first, F.col("hs")).otherwise(F.col("aws")))
    b = F.sum(F.when(F.col("home") == first, F.col("aws")).otherwise(F.col("hs")))
    keys = ["page", "section", "matchday", "__pair"]
    level = m.where(F.col("phase") == KNOCKOUT).groupBy(*series).agg(F.count("*").alias("__n"), a.alias("__a"), b.alias("__b")).where("__n = 2 and __a = __b")
    level = level.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)))
    odd = m.where("hpens is not null and hs <> aws").select("page", "row_id", "phase", "hs", "aws", "hpens", "apens", *(e.alias(f"__s{i}") for i, e in enumerate(series)))
    odd = odd.join(level, reduce(Column.__and__, (F.col(f"__s{i}").eqNullSafe(F.col(f"__k{i}")) for i in range(len(keys))), F.coalesce(F.col("phase") == KNOCKOUT, F.lit(False))), "left_anti")
    return finding(odd, "shootout_without_draw", True, F.col("row_id"), text(F.col("hs"), "-", F.col("aws"), " (", F.col("hpens"), "-", F.col("apens"), ")"))


def duplicates(m: DataFrame) -> DataFrame:
    twice = m.where("date <> ''").groupBy("page", "date", "home", "away").agg(F.count("*").alias("n")).where("n > 1")
    return finding(twice, "duplicate", True, text(F.col("date"), " ", F.col("home"), " ", F.col("away")), text(F.col("n")))


def self_play(m: DataFrame) -> DataFrame:
    return finding(m.where("home <> '' and home = away"), "self_play", True, F.col("row_id"), F.col("home"))


def partial_groups(m: DataFrame) -> DataFrame:
    """Stages some of whose matches have a group and others none."""
    held = m.where(F.col("phase") == GROUPS).groupBy("page", "section").agg(played(m).alias("n"), played(m, F.col("grp") == "").alias("missing"))
    return finding(held.where("missing > 0 and missing < n"), "partial_groups", True, F.col("section"), text(F.col("missing"), "/", F.col("n")))


def round_robin(m: DataFrame, by_section: bool = False) -> DataFrame:
    """Groups whose clubs have played unequal numbers of matches, or numbers that make no whole round robin."""
    keys = ["page", *(["section"] if by_section else []), "grp"]
    own = m.where((F.col("phase") == GROUPS) & F.col("grp").rlike(GROUP))
    clubs = sides(own, *keys[1:], *times(m)).groupBy(*keys, "club").agg(played(m).alias("n"))
    held = clubs.groupBy(*keys).agg(F.count("*").alias("clubs"), F.min("n").alias("least"), F.max("n").alias("most"), F.sum("n").alias("total"))
    where = F.concat_ws(" ", *keys[1:])
    unequal = finding(held.where("least <> most"), "unequal_games", False, where, text(F.col("least"), "-", F.col("most")))
    one = F.col("clubs") * (F.col("clubs") - 1)  # twice the matches of one round, as `total` is twice the matches
    odd = finding(held.where((F.col("least") == F.col("most")) & (one > 0) & (F.col("total") % F.when(one > 0, one).otherwise(1) != 0)), "incomplete_round_robin", False, where, text(F.col("clubs"), ": ", F.col("total")))
    return unequal.union(odd)


def once_per_matchday(m: DataFrame) -> DataFrame:
    keys = ["page", "section", "grp", "matchday"]
    twice = sides(m.where((F.col("phase") == GROUPS) & (F.col("matchday") != "")), *keys[1:], *times(m)).groupBy(*keys, "club").agg(played(m).alias("n")).where("n > 1")
    got = sample(twice, keys, ["club"], 4, F.col("club"))
    return finding(got, "twice_a_matchday", True, F.concat_ws(" / ", "section", "grp", "matchday"), F.col("shown"))


#: Missing matchdays in a row up to which each is told.
LONG_GAP = 50


def numbered(m: DataFrame) -> DataFrame:
    return m.where(F.col("phase") == GROUPS).withColumn("n", label_number(F.col("matchday"))).where("n > 0")


def matchday_gaps(m: DataFrame) -> DataFrame:
    """Numbers that are missing between a page's first matchday and its last; a gap of over LONG_GAP numbers is told by its ends, so that no label builds a long list."""
    following = F.lead("n").over(Window.partitionBy("page").orderBy("n"))
    days = numbered(m).select("page", "n").distinct().withColumn("next", following)
    first, last = F.col("n") + 1, F.col("next") - 1
    each = F.array_join(F.transform(F.sequence(first, last), lambda k: k.cast("string")), ", ")
    lack = F.when(last - first + 1 > LONG_GAP, text(first, "-", last)).when(last >= first, each)
    told = F.collect_list(F.when(lack.isNotNull(), F.struct("n", lack.alias("lack"))))  # of distinct matchdays
    got = days.groupBy("page").agg(F.min("n").alias("first"), F.max("n").alias("last"), F.array_sort(told).alias("of")).where("size(of) > 0")
    return finding(got, "matchday_gap", False, text(F.col("first"), "-", F.col("last")), F.array_join(F.transform("of", lambda x: x["lack"]), ", "))


def upper_medians(m: DataFrame) -> DataFrame:
    """page, n, mid: of each matchday its upper median date. Ranks come from counts of each distinct date, so a crowded matchday is not collected."""
    held = numbered(m).where("date <> ''").groupBy("page", "n", "date").agg(F.count("*").alias("k"))
    day = Window.partitionBy("page", "n")
    ranked = held.withColumn("upto", F.sum("k").over(day.orderBy("date"))).withColumn("all", F.sum("k").over(day))
    return ranked.where(F.col("upto") > F.floor(F.col("all") / 2)).groupBy("page", "n").agg(F.min("date").alias("mid"))


def year_order(m: DataFrame, most_days: int = 180) -> DataFrame:
    """A matchday whose upper median date is far before that of the matchday before."""
    before = Window.partitionBy("page").orderBy("n")
    got = upper_medians(m).withColumn("last", F.lag("mid").over(before)).withColumn("last_n", F.lag("n").over(before))
    got = got.where(day_number(F.col("last")) - day_number(F.col("mid")) > most_days)
    return finding(got, "year_order", True, text(F.col("n"), " after ", F.col("last_n")), text(F.col("mid"), " ", F.col("last")))


def one_group(m: DataFrame) -> DataFrame:
    """Clubs with more than one group in one stage."""
    keys = ["page", "section", "club"]
    own = m.where((F.col("phase") == GROUPS) & F.col("grp").rlike(STAGE_GROUP))
    held = sides(own, "section", "grp", *times(m)).groupBy(*keys, "grp").agg(played(m).alias("n"))
    got = held.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("grp", "n"))).alias("of")).where("size(of) > 1")  # of a club's groups
    return finding(got, "two_groups", True, F.concat_ws(" / ", "section", "club"), F.array_join(F.transform("of", lambda x: F.concat(x["grp"], F.lit(" "), x["n"])), ", "))


def home_balance(m: DataFrame) -> DataFrame:
    """Pairs that meet an even number of times in a group, but not half of it at either's home."""
    own = m.where((F.col("phase") == GROUPS) & (F.col("matchday") != "") & (F.col("home") != "") & (F.col("away") != ""))
    pairs = own.select("page", "section", "grp", F.least("home", "away").alias("one"), F.greatest("home", "away").alias("two"), "home", *times(m))
    got = pairs.groupBy("page", "section", "grp", "one", "two").agg(played(m).alias("n"), played(m, F.col("home") == F.col("one")).alias("at_one"))
    odd = got.where("n % 2 = 0 and (at_one * 2 <> n or one = two)")
    return finding(odd, "home_balance", False, F.concat_ws(" / ", "section", "grp", "one", "two"), text(F.col("at_one"), "/", F.col("n")))


def chain(m: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = cut) -> DataFrame:
    """Knockout rounds must follow from each other: who plays a round after having played before has won the round before.

    A page's stages are looked at one by one (a stage with few matches only if the page has several). Rounds are
    ordered by the ladder. Where a label is not on it: a single label is no chain; labels that share no club are
    series of their own; labels with exactly the same clubs are legs of one round, ordered by their first date; else
    the stage can't be reviewed, which is said. New entrants are told; undecided pairs are excused unless both go on.

    The matches are read once: what the check needs of them is written as a table (keep), and so are the rounds.
    """
    key = ["page", "section"]
    won = winner(*(F.col(c) for c in ("home", "away", "hs", "aws", "hpens", "apens")))
    own = m.where((F.col("phase") == KNOCKOUT) & (F.col("date") != "")).select(*key, "row_id", "date", "matchday", "home", "away", "hs", "aws", won.alias("won"), round_rank(round_name(F.col("matchday"))).alias("rung"))
    stage = Window.partitionBy(*key)
    own = keep(own.withColumn("n", F.count("*").over(stage)).withColumn("off", F.count_if(F.col("rung").isNull()).over(stage)).where("n >= 3"), "knockout")
    # where every label is known, its place on the ladder orders the rounds
    laddered = own.where("off = 0").withColumn("k", F.dense_rank().over(stage.orderBy("rung")))
    folded, told = _by_roster(own.where("off > 0"))
    cols = [*key, "k", "row_id", "home", "away", "won"]
    # a row for each side of a match, with its club's next round
    side = lambda club, rival: F.struct(F.col(club).alias("club"), F.col(rival).alias("rival"))
    plays = laddered.select(*cols).union(folded.select(*cols)).select(*key, "k", "row_id", "won", F.inline(F.array(side("home", "away"), side("away", "home")))).where("club <> ''")
    of_club = Window.partitionBy(*key, "club").orderBy("k")
    # from the last round back: a frame that follows a row to the end is summed up anew for each row
    later = F.min("k").over(Window.partitionBy(*key, "club").orderBy(F.desc("k")).rangeBetween(Window.unboundedPreceding, -1))
    plays = plays.withColumn("on", F.coalesce(later == F.col("k") + 1, F.lit(False)))
    # a club that goes on from an undecided match is excused, unless its rival goes on too
    both = F.min("on").over(Window.partitionBy(*key, "k", "row_id")) & (F.count("*").over(Window.partitionBy(*key, "k", "row_id")) == 2) & (F.col("club") != F.col("rival"))
    plays = keep(plays.withColumn("pardoned", (F.col("won") == "") & (F.col("rival") != "") & ~both), "sides")

    held = plays.groupBy(*key, "k", "club").agg(F.max(F.col("won") == F.col("club")).alias("wins"), F.max("pardoned").alias("pardoned"))
    last = F.lag("k").over(of_club) == F.col("k") - 1
    seen = held.withColumns({
        "debut": F.min("k").over(Window.partitionBy(*key, "club")), "passed": last & F.lag("wins").over(of_club), "excused": last & F.lag("pardoned").over(of_club),
        "reviewable": F.max("wins").over(stage.orderBy("k").rangeBetween(-1, -1)),
    }).where("reviewable")
    where = text(F.col("section"), " / ", F.col("k"))
    marked = seen.select(*key, "k", "club", F.when(F.col("debut") == F.col("k"), "chain_entrants").when(~F.coalesce("passed", F.lit(False)) & ~F.coalesce("excused", F.lit(False)), "chain_broken").alias("check")).where("check is not null")
    fresh = finding(marked.where("check = 'chain_entrants'"), "chain_entrants", False, where, F.col("club"))
    broken = plays.join(marked.where("check = 'chain_broken'").drop("check"), [*key, "k", "club"])
    return told.union(fresh).union(finding(broken, "chain_broken", False, where, text(F.col("row_id"), " ", F.col("club"))))


def _by_roster(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stages with labels off the ladder: their matches with the round k that equal rosters make, and what is to be told of the others."""
    key = ["page", "section"]
    clubs = sides(own, "section", "matchday").where("club <> ''").select(*key, "matchday", "club").distinct()
    # labels that share a club: one that is in more than one of them is enough
    shared = clubs.groupBy(*key, "club").agg(F.count("*").alias("labels")).groupBy(*key).agg((F.max("labels") > 1).alias("linked"))
    roster = clubs.groupBy(*key, "matchday").agg(F.array_join(F.array_sort(F.collect_set("club")), "\t").alias("roster"))  # of a round's clubs
    opens = own.groupBy(*key, "matchday").agg(F.min("date").alias("opens")).join(roster, [*key, "matchday"], "left").join(shared, key, "left")
    stage = Window.partitionBy(*key)
    labels = opens.withColumns({
        "labels": F.count("*").over(stage), "rosters": F.size(F.collect_set("roster").over(stage)),
        "opens": F.min("opens").over(Window.partitionBy(*key, "roster")),
    }).where("labels > 1")
    folds = F.col("linked") & (F.col("rosters") > 1) & (F.col("rosters") < F.col("labels"))
    judged = labels.withColumn("kind", F.when(~F.coalesce("linked", F.lit(False)), "chain_none").when(~folds, "chain_not_reviewed"))
    ordered = judged.where("kind is null").select(*key, "matchday", F.dense_rank().over(stage.orderBy("opens", "roster")).alias("k"))
    told = judged.where("kind is not null").select(*key, "kind").distinct()
    return own.join(ordered, [*key, "matchday"]), told.select("page", F.col("kind").alias("check"), F.lit(False).alias("severe"), F.col("section").alias("subject"), F.lit("").alias("detail"))


CHECKS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "completeness": completeness, "undated": undated, "shootouts": shootouts, "duplicates": duplicates, "self_play": self_play,
    "partial_groups": partial_groups, "round_robin": round_robin, "once_per_matchday": once_per_matchday, "matchday_gaps": matchday_gaps,
    "year_order": year_order, "one_group": one_group, "home_balance": home_balance, "chain": chain,
}


#: Checks that count matches by these columns, whatever else is in them.
FOLDS = ("partial_groups", "round_robin", "once_per_matchday", "matchday_gaps", "one_group", "home_balance")
ALIKE = ["page", "phase", "section", "grp", "matchday", "home", "away"]


def folded(m: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = cut) -> DataFrame:
    """Matches for FOLDS and unknown_names(), as a table: those alike in page, stage, group, matchday and clubs are one row, and `times` says how many."""
    return keep(m.groupBy(*ALIKE).agg(F.count("*").alias("times")), "folded")


def review(m: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The findings of all checks; unknown_names() only with a registry of known names. Sort by severe for a report.

    What only counts matches reads them folded, so that all those checks together read them once."""
    few = folded(m)
    found = [check(few if name in FOLDS else m) for name, check in CHECKS.items()] + ([unknown_names(few, known)] if known is not None else [])
    return reduce(DataFrame.union, found)
