"""Preference judgements: counting fulfilled preferences without listing document pairs.

A judgement group (jg) states, per sub-group (jsg), that documents of a higher level are
preferred to those of a lower one. Listing the preferred pairs grows with the square of
the group, so pairs are only ever counted:

* Documents of a group that carry the same judgements form one *class*; levels of a sub-group
  are numbered from 0.
* With several sub-groups preferences are transitive across them. The closure keeps, for each class
  and sub-group, the level below which everything is below the class (its *reach*). It is
  found on (sub-group, level) nodes by doubling: rounds grow with the logarithm of the longest chain.
* A document is below a class when one of its levels is under the class's reach. Then all its levels are
  at most the reach, so the first such sub-group, with equal levels before it, is found once.
  A level is under a reach when the two numbers differ first in a bit that the reach has. So a
  class gets *tags* (sub-groups, place, levels before, bit, higher bits), those it has as the
  upper and those it has as the lower document, and a pair is preferred exactly
  when the upper tags of one meet the lower tags of the other, in one tag.
* Pairs are then counted by running sums per tag in rank order: rows grow with documents x log(levels).
* Agreement over groups counts pairs that are preferred in p groups and dispreferred in q others,
  by the same sums over combinations of tags; binomial inversion gives the pairs of each
  exact count. Topics with so many groups that combinations outnumber documents x profiles compare
  profiles instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, written
from .checks import InputError, once, preference_conflicts, require_none
from .measures import long_form, ratio
from .ordered import GroupSize, OrderedGroups, fits, group_size, known_size
from .ranking import _KEY, Size, rank_run, run_order, topics_in_both, with_key

_JG = ["qid", "jg"]
# Pairs of documents that are both retrieved, of which one is, and of which none is.
AREAS = ("ret", "imp", "none")


def pref_documents(
    run: DataFrame, prefs: DataFrame, max_docs: int | None = None, size: Size = None
) -> DataFrame:
    """(qid, docno, doc_rank, retrieved): judged documents numbered from 0 per topic.

    Retrieved ones come first in rank order (equal scores by ascending id), then the rest
    by id.
    """
    if max_docs is not None:
        run = rank_run(run, ties="asc", max_docs=max_docs)
    if size is None:
        size = group_size(prefs, ["qid"])
    run = once(run.select("qid", "docno", "score"), ["qid", "docno"], "result")
    judged = topics_in_both(prefs, run).select("qid", "docno").distinct()
    scored = judged.join(run, ["qid", "docno"], "left")
    rows = scored.withColumn("retrieved", F.col("score").isNotNull())
    numbered = OrderedGroups(with_key(rows), ["qid"], _places(), size).number("doc_rank").df
    return numbered.select("qid", "docno", (F.col("doc_rank") - 1).alias("doc_rank"), "retrieved")


def _places() -> list[Column]:
    """Retrieved documents come first in rank order (equal scores by ascending id), then the rest by id."""
    return [F.col("retrieved").desc(), *run_order("asc")]


def _placed(rows: DataFrame, size: GroupSize) -> DataFrame:
    """``rows`` with ``doc_rank``, from 0; a topic that fits a task takes one exchange and no join."""
    if fits(rows, size):
        place = F.dense_rank().over(Window.partitionBy("qid").orderBy(*_places())).cast("long")
        rows = rows.repartition("qid").withColumn("doc_rank", place - 1)
    else:
        documents = rows.select("qid", "docno", "retrieved", _KEY).distinct()
        places = OrderedGroups(documents, ["qid"], _places(), size).number("doc_rank").df
        rows = rows.join(places.select("qid", "docno", (F.col("doc_rank") - 1).alias("doc_rank")), ["qid", "docno"])
    return rows.drop(_KEY).filter("docno IS NOT NULL")


def _members(prefs: DataFrame) -> DataFrame:
    """(qid, docno, jg, members, level): one row for a document of a group, with its judgements and the highest level.

    Windows sort once, in an order that a join on topic and document takes over, where collecting groups
    sorts before and after their exchange.
    """
    rows = prefs.select("qid", "docno", "jg", "jsg", F.col("rel_level").cast("double").alias("level"))
    group = Window.partitionBy("qid", "docno", "jg").orderBy("jsg", "level")
    every = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "qid", "docno", "jg", F.collect_list(F.struct("jsg", "level")).over(every).alias("members"),
        F.max("level").over(every).alias("level"), F.row_number().over(group).alias("_no"),
    ).filter("_no = 1").drop("_no")
    members = F.col("members")
    return rows.withColumn("members", F.when(F.size(members) > 1, F.array_distinct(members)).otherwise(members))


class Preferences:
    """Judged documents of a run with their classes, and the tables counted from them."""

    def __init__(
        self,
        run: DataFrame,
        prefs: DataFrame,
        max_docs: int | None = None,
        size: Size = None,
        checked: bool = False,
    ) -> None:
        # One grouping of the judgements serves the check, the places and the classes.
        judged = _members(prefs)
        if max_docs is not None:
            run = rank_run(run, ties="asc", max_docs=max_docs)
        run = once(run.select("qid", "docno", "score"), ["qid", "docno"], "result")
        # Files, unlike checkpoints, are read by the columns asked for.
        scored = written(with_key(judged.join(run, ["qid", "docno"], "left")).drop("score"), "judged")
        if checked:
            require_none(_member_conflicts(scored), "contradictory preferences")
        rows = topics_in_both(scored, run).withColumn("retrieved", F.col(_KEY).isNotNull())
        size = known_size(scored if size is None else rows.select("qid", "docno").distinct(), ["qid"], size)
        #: (qid, jg, docno, members, level, doc_rank, retrieved)
        self.rows = written(_placed(rows, size), "places")
        retrieved, members = F.col("retrieved"), F.col("members")
        # A class is named by the first of its documents.
        classes = self.rows.groupBy(*_JG, "members").agg(
            F.min("doc_rank").alias("class"),
            F.max("level").alias("level"),
            F.count_if(retrieved).alias("n_ret"),
            F.count_if(~retrieved).alias("n_un"),
        )
        classes = durable(classes)
        first, last = F.min(members[0]["jsg"]), F.max(F.element_at(members, -1)["jsg"])
        alone = F.max(F.size(members)) == 1
        groups = classes.groupBy(*_JG).agg(((first == last) & alone).alias("single"))
        self.classes = durable(classes.join(groups, _JG))
        documents_of_class = self.classes.select(*_JG, (F.col("n_ret") + F.col("n_un")).alias("n"))
        self.group_size = _summed_size(documents_of_class, _JG)
        self.topic_size = _summed_size(documents_of_class, ["qid"])
        self._judged: DataFrame | None = None
        self._reach: DataFrame | None = None
        self._tags: DataFrame | None = None
        self._profiles: DataFrame | None = None
        self._agreement: DataFrame | None = None

    @property
    def judged(self) -> DataFrame:
        """(qid, jg, docno, class, level, single, doc_rank, retrieved): documents with their classes."""
        if self._judged is None:
            named = self.classes.select(*_JG, "members", "class", "single")
            self._judged = durable(self.rows.join(named, [*_JG, "members"]).drop("members"))
        return self._judged

    # -- relations between classes ------------------------------------------------

    def explicit(self) -> DataFrame:
        """(qid, jg, jsg, level, below, pairs): judged levels of a sub-group, preferred over
        unpreferred, with the number of document pairs they stand for."""
        levels = (
            self.classes.select(*_JG, (F.col("n_ret") + F.col("n_un")).alias("n"), F.inline("members"))
            .groupBy(*_JG, "jsg", "level")
            .agg(F.sum("n").alias("n"))
        )
        lower = levels.select(*_JG, "jsg", F.col("level").alias("below"), F.col("n").alias("n_below"))
        return (
            levels.join(lower, [*_JG, "jsg"])
            .filter("level > below")
            .select(*_JG, "jsg", "level", "below", (F.col("n") * F.col("n_below")).alias("pairs"))
        )

    def numbered_members(self) -> DataFrame:
        """(qid, jg, class, single, jsg, no, bits): level numbers of each class, and their bits."""
        members = self.classes.select(*_JG, "class", "single", F.inline("members"))
        levels = members.select(*_JG, "jsg", "level").distinct()
        numbered = OrderedGroups(levels, [*_JG, "jsg"], [F.col("level")], self.group_size).number("no").df
        numbered = durable(numbered.withColumn("no", F.col("no") - 1))
        bits = numbered.groupBy(*_JG, "jsg").agg(F.length(F.bin(F.max("no"))).alias("bits"))
        return members.join(numbered.join(bits, [*_JG, "jsg"]), [*_JG, "jsg", "level"]).drop("level")

    def reach(self) -> DataFrame:
        """(qid, jg, class, single, jsg, no, reach, bits): the level number of each sub-group under
        which everything is below the class; ``no`` is its own level there, if it has one."""
        if self._reach is not None:
            return self._reach
        members = durable(self.numbered_members())
        highest = Window.partitionBy(*_JG, "class", "jsg")
        own = members.withColumn("reach", F.max("no").over(highest))
        several = members.filter("NOT single")
        other = several.select(*_JG, "class", F.col("jsg").alias("to"), F.col("no").alias("to_no"))
        bridges = (
            several.join(other, [*_JG, "class"])
            .filter("jsg <> to OR no < to_no")
            .groupBy(*_JG, "jsg", "to", "no")
            .agg(F.max("to_no").alias("to_no"))
        )
        bridges = durable(bridges)
        if bridges.isEmpty():
            self._reach = own
            return own
        # From below level ``no`` of a sub-group one gets to the highest level that a document there
        # has in another: a running maximum over the lower levels.
        nodes = several.select(*_JG, "jsg", "no").distinct()
        ways = bridges.select(*_JG, "jsg", "to").distinct()
        steps = nodes.join(ways, [*_JG, "jsg"]).join(bridges, [*_JG, "jsg", "to", "no"], "left")
        steps = OrderedGroups(steps, [*_JG, "jsg", "to"], [F.col("no")], self.group_size)
        steps = steps.running_max({"up_to": F.col("to_no")}).df.filter("up_to IS NOT NULL")
        direct = steps.select(*_JG, "jsg", (F.col("no") + 1).alias("no"), "to", F.col("up_to").alias("reach"))
        state = durable(
            nodes.select(*_JG, "jsg", "no", F.col("jsg").alias("to"), F.col("no").alias("reach"))
            .unionByName(direct.join(nodes, [*_JG, "jsg", "no"], "left_semi"))
            .withColumn("grew", F.lit(True))
        )
        while True:  # paths of twice the length in each round
            onward = state.select(
                *_JG, F.col("jsg").alias("to"), F.col("no").alias("reach"), F.col("to").alias("to2"), F.col("reach").alias("reach2")
            )
            longer = state.join(onward, [*_JG, "to", "reach"]).select(
                *_JG, "jsg", "no", F.col("to2").alias("to"), F.col("reach2").alias("reach"), F.lit(None).cast("long").alias("old")
            )
            grown = (
                state.select(*_JG, "jsg", "no", "to", "reach", F.col("reach").alias("old"))
                .unionByName(longer)
                .groupBy(*_JG, "jsg", "no", "to")
                .agg(F.max("reach").alias("reach"), F.max("old").alias("old"))
            )
            grew = F.col("old").isNull() | (F.col("reach") > F.col("old"))
            state = durable(grown.withColumn("grew", grew).drop("old"))
            if state.filter("grew").isEmpty():
                break
        bits = members.groupBy(*_JG, "jsg").agg(F.first("bits").alias("bits"))
        reached = (
            several.select(*_JG, "class", "jsg", "no")
            .join(state.drop("grew"), [*_JG, "jsg", "no"])
            .groupBy(*_JG, "class", F.col("to").alias("jsg"))
            .agg(F.max("reach").alias("reach"))
            .join(bits, [*_JG, "jsg"])
            .join(several.select(*_JG, "class", "jsg", "no"), [*_JG, "class", "jsg"], "left")
            .withColumn("single", F.lit(False))
        )
        self._reach = durable(own.filter("single").unionByName(reached.select(own.columns)))
        return self._reach

    def reach_levels(self) -> DataFrame:
        """(qid, jg, doc_rank, jsg, level): the reach of every document in groups with several
        sub-groups, as levels."""
        own = self.classes.select(*_JG, "class", F.inline("members")).join(
            self.numbered_members().select(*_JG, "class", "jsg", "no").distinct(), [*_JG, "class", "jsg"]
        )
        levels = own.select(*_JG, "jsg", F.col("no").alias("reach"), "level").distinct()
        reach = self.reach().filter("NOT single").select(*_JG, "class", "jsg", "reach").distinct()
        documents = self.judged.select(*_JG, "class", "doc_rank")
        return (
            reach.join(levels, [*_JG, "jsg", "reach"])
            .join(documents, [*_JG, "class"])
            .select(*_JG, "doc_rank", "jsg", "level")
        )

    def tags(self) -> DataFrame:
        """(qid, jg, class, tag, hi): the tags a class has as the preferred document and as the other.

        Two classes are preferred exactly when an upper tag of one is a lower tag of the other, and then in
        one tag.
        """
        if self._tags is not None:
            return self._tags
        place = F.struct("jsg", "reach", "no", "bits")
        classes = (
            self.reach()
            .groupBy(*_JG, "class")
            .agg(F.array_sort(F.collect_list(place)).alias("all"))
            .withColumn("own", F.filter("all", lambda x: x["no"].isNotNull()))
            .withColumn("subs", F.transform("own", lambda x: x["jsg"]))
        )
        kinds = classes.groupBy(*_JG, "subs").agg(F.min("class").alias("kind"))
        classes = durable(classes)
        lower = classes.join(kinds, [*_JG, "subs"]).select(
            *_JG, "class", "kind", F.lit(False).alias("hi"),
            F.transform("own", lambda x: F.struct(x["no"].alias("value"), x["bits"].alias("bits"))).alias("path"),
        )
        reached = F.map_from_entries(F.transform("all", lambda x: F.struct(x["jsg"], F.struct(x["reach"].alias("value"), x["bits"].alias("bits")))))
        upper = classes.withColumn("reached", reached).drop("subs").join(kinds, _JG).select(
            *_JG, "class", "kind", F.lit(True).alias("hi"),
            F.transform("subs", lambda s: F.try_element_at("reached", s)).alias("path"),
        )
        paths = lower.unionByName(upper).select("*", F.posexplode("path").alias("at", "x"))
        before = F.slice("path", 1, F.col("at"))
        # All sub-groups before this one must be reached, and this one.
        paths = paths.filter(F.col("x").isNotNull() & F.forall(before, lambda y: y.isNotNull()))
        prefix = F.array_join(F.transform(before, lambda y: y["value"].cast("string")), ",")
        bit = F.explode(F.sequence(F.lit(0), F.col("x.bits") - 1)).alias("bit")
        cut = paths.select(*_JG, "class", "hi", "kind", "at", prefix.alias("prefix"), F.col("x.value").alias("value"), bit)
        has = F.expr("shiftright(value, bit) & 1") == 1
        tag = F.concat_ws(":", "kind", "at", "prefix", "bit", F.expr("shiftright(value, bit + 1)"))
        self._tags = durable(cut.filter(has == F.col("hi")).select(*_JG, "class", tag.alias("tag"), "hi"))
        return self._tags

    def relation(self) -> DataFrame:
        """(qid, jg, class, below): class preferred to class, one row per pair of classes."""
        tags = self.tags()
        lower = tags.filter("NOT hi").select(*_JG, "tag", F.col("class").alias("below"))
        return tags.filter("hi").join(lower, [*_JG, "tag"]).select(*_JG, "class", "below")

    def closure(self) -> DataFrame:
        """(qid, jg, class, below) of groups with several sub-groups; classes as their judgements."""
        names = self.classes.filter("NOT single").select(*_JG, "class", F.to_json("members").alias("name"))
        below = names.select(*_JG, F.col("class").alias("below"), F.col("name").alias("below_name"))
        pairs = self.relation().join(names, [*_JG, "class"]).join(below, [*_JG, "below"])
        return pairs.select(*_JG, F.col("name").alias("class"), F.col("below_name").alias("below"))

    def contradictions(self) -> DataFrame:
        """Classes preferred to themselves after closure: the judgements form a cycle."""
        return self.reach().filter("no < reach").select(*_JG, "class")

    def check(self) -> Preferences:
        example = self.contradictions().limit(1).collect()
        if example:
            raise InputError(f"contradictory preferences: {example[0].asDict()}")
        return self

    # -- counts per judgement group -----------------------------------------------

    def doc_counts(self) -> DataFrame:
        """Relevant and non-relevant judged documents per group, retrieved or not.

        With one sub-group every level up to 0 is non-relevant; with several only level 0.
        """
        rel = F.col("level") > 0
        nonrel = F.when(F.col("single"), F.col("level") <= 0).otherwise(F.col("level") == 0)
        both = F.col("n_ret") + F.col("n_un")

        def total(condition: Column, n: Column) -> Column:
            return F.sum(F.when(condition, n).otherwise(0))

        return self.classes.groupBy(*_JG).agg(
            total(rel, F.col("n_ret")).alias("num_rel_ret"),
            total(rel, both).alias("num_rel"),
            total(nonrel, F.col("n_ret")).alias("num_nonrel_ret"),
            total(nonrel, both).alias("num_nonrel"),
        )

    def counted(self, documents: DataFrame) -> DataFrame:
        """Fulfilled and possible preferences among ``documents`` (rows of ``judged``), per group."""
        ret = F.col("retrieved")
        sizes = documents.groupBy(*_JG, "class").agg(F.count_if(ret).alias("ret"), F.count_if(~ret).alias("un"))
        seen = documents.filter("retrieved").select(*_JG, "class", "doc_rank").join(self.tags(), [*_JG, "class"])
        return self._counted(sizes, seen)

    def _counted(self, sizes: DataFrame, seen: DataFrame) -> DataFrame:
        """The same from the sizes of classes and the retrieved documents (doc_rank) in each of their tags.

        Retrieved documents rank above others, so only pairs of retrieved ones depend on places; the
        others are products of numbers of documents per tag.
        """
        tags = self.tags()
        n, hi = F.col, F.col("hi")
        kinds = [(f"{side}_{kind}", is_side, kind) for side, is_side in (("hi", hi), ("lo", ~hi)) for kind in ("ret", "un")]
        counts = (
            sizes.join(tags, [*_JG, "class"])
            .groupBy(*_JG, "tag")
            .agg(*[F.sum(F.when(is_side, n(kind)).otherwise(0)).alias(name) for name, is_side, kind in kinds])
            .groupBy(*_JG)
            .agg(
                F.sum(n("hi_ret") * n("lo_ret")).alias("poss_ret"),
                F.sum(n("hi_ret") * n("lo_un")).alias("ful_imp"),
                F.sum(n("hi_ret") * n("lo_un") + n("lo_ret") * n("hi_un")).alias("poss_imp"),
                F.sum(n("hi_un") * n("lo_un")).alias("poss_none"),
            )
        )
        # Lower documents at places p1, p2, .. of a tag have p1 - 1, p2 - 2, .. upper ones above them.
        places = OrderedGroups(seen, [*_JG, "tag"], [n("doc_rank")], self.group_size).number("place").df
        lower = places.filter(~hi).groupBy(*_JG, "tag").agg(F.sum("place").alias("places"), F.count("*").alias("n"))
        above = (n("places") - F.expr("n * (n + 1) div 2")).alias("ful")
        ful = lower.select(*_JG, above).groupBy(*_JG).agg(F.sum("ful").alias("ful_ret"))
        return counts.join(ful, _JG, "left").select(
            *_JG, F.coalesce("ful_ret", F.lit(0)).alias("ful_ret"), "poss_ret", "ful_imp", "poss_imp", "poss_none"
        )

    def group_counts(self) -> DataFrame:
        """Fulfilled and possible preferences per group.

        ``ful_ret poss_ret`` both documents retrieved, ``ful_imp poss_imp`` one of them,
        ``poss_none`` neither; possible counts include the fulfilled ones.
        """
        sizes = self.classes.select(*_JG, "class", F.col("n_ret").alias("ret"), F.col("n_un").alias("un"))
        # All documents of a class have its tags, so they meet them by their judgements, without its name.
        tags = self.tags().groupBy(*_JG, "class").agg(F.collect_list(F.struct("tag", "hi")).alias("tags"))
        tags = self.classes.select(*_JG, "members", "class").join(tags, [*_JG, "class"]).drop("class")
        seen = self.rows.filter("retrieved").select(*_JG, "members", "doc_rank").join(tags, [*_JG, "members"])
        pairs = self._counted(sizes, seen.select(*_JG, "doc_rank", F.inline("tags")))
        return self.doc_counts().join(pairs, _JG, "left").na.fill(0)

    def balanced_counts(self, strict: bool = False) -> DataFrame:
        """Preferences with as many non-relevant as relevant documents, per group.

        (ful, poss) and, for retrieved documents alone, (ful_r, poss_r). Too few non-relevant
        documents: fulfilled preferences are added. Too many: only the first ones in rank
        order count. There, with one sub-group, the lowest class is also compared to the kept
        non-relevant documents; ``strict`` leaves those comparisons out.
        """
        c = F.col
        counts = self.group_counts()
        few = c("num_rel") - c("num_nonrel")
        few_r = c("num_rel_ret") - c("num_nonrel_ret")
        added = counts.select(
            *_JG,
            few.alias("few"),
            few_r.alias("few_r"),
            (c("ful_ret") + c("ful_imp") + c("num_rel_ret") * few).alias("ful_few"),
            (c("poss_ret") + c("poss_imp") + c("poss_none") + c("num_rel") * few).alias("poss_few"),
            (c("ful_ret") + c("num_rel_ret") * few_r).alias("ful_r_few"),
            (c("poss_ret") + c("num_rel") * few_r).alias("poss_r_few"),
        )
        cut = self._cut_single(strict).unionByName(self._cut_multi())
        joined = added.join(cut, _JG, "left")
        return joined.select(
            *_JG,
            F.when(c("few") >= 0, c("ful_few")).otherwise(c("ful_cut")).alias("ful"),
            F.when(c("few") >= 0, c("poss_few")).otherwise(c("poss_cut")).alias("poss"),
            F.when(c("few_r") >= 0, c("ful_r_few")).otherwise(c("ful_r_cut")).alias("ful_r"),
            F.when(c("few_r") >= 0, c("poss_r_few")).otherwise(c("poss_r_cut")).alias("poss_r"),
        )

    def _cut_single(self, strict: bool) -> DataFrame:
        c = F.col
        counts = self.doc_counts()
        lowest = self.classes.filter("single").groupBy(*_JG).agg(F.min("level").alias("lowest"))
        rows = (
            self.judged.filter("single")
            .select(*_JG, "class", "doc_rank", "retrieved", "level")
            .join(counts.join(lowest, _JG), _JG)
            .withColumn("low", c("level") == c("lowest"))
        )
        upper = c("retrieved") & ~c("low") if strict else c("retrieved")
        kept = (
            OrderedGroups(rows, _JG, [c("doc_rank").asc()], self.group_size)
            .running(
                {
                    "low_seen": c("low").cast("int"),
                    "upper_seen": upper.cast("int"),
                }
            )
            .df.filter("low")
            .withColumn("above", c("upper_seen") - upper.cast("int"))
        )
        in_cut = c("low_seen") <= c("num_rel")
        in_cut_r = c("retrieved") & (c("low_seen") <= c("num_rel_ret"))
        to_kept = kept.groupBy(*_JG).agg(
            F.sum(F.when(in_cut, c("above")).otherwise(0)).alias("kept_ful"),
            F.sum(F.when(in_cut_r, c("above")).otherwise(0)).alias("kept_ful_r"),
        )
        upper_class = ~c("low") | F.lit(not strict)
        sizes = (
            self.classes.filter("single")
            .join(lowest, _JG)
            .withColumn("low", c("level") == c("lowest"))
            .groupBy(*_JG)
            .agg(
                F.sum(F.when(upper_class, c("n_ret") + c("n_un")).otherwise(0)).alias("n_all"),
                F.sum(F.when(upper_class, c("n_ret")).otherwise(0)).alias("n_all_ret"),
                F.sum(F.when(c("low"), c("n_ret") + c("n_un"))).alias("n_lowest"),
                F.sum(F.when(c("low"), c("n_ret"))).alias("n_lowest_ret"),
            )
        )
        among = self.counted(rows.filter(~c("low")))
        joined = (
            sizes.join(counts, _JG)
            .join(to_kept, _JG, "left")
            .join(among, _JG, "left")
            .na.fill(0)
        )
        up_poss = c("poss_ret") + c("poss_imp") + c("poss_none")
        return joined.select(
            *_JG,
            (c("ful_ret") + c("ful_imp") + c("kept_ful")).alias("ful_cut"),
            # Several non-relevant levels: the lowest class may hold fewer documents.
            (up_poss + c("n_all") * F.least("num_rel", "n_lowest")).alias("poss_cut"),
            (c("ful_ret") + c("kept_ful_r")).alias("ful_r_cut"),
            (c("poss_ret") + c("n_all_ret") * F.least("num_rel_ret", "n_lowest_ret")).alias("poss_r_cut"),
        )

    def _cut_multi(self) -> DataFrame:
        c = F.col
        counts = self.doc_counts().select(*_JG, "num_rel")
        rows = self.judged.filter("NOT single").join(counts, _JG)
        seen = (
            OrderedGroups(
                rows.withColumn("nonrel", c("level") == 0), _JG, [c("doc_rank").asc()], self.group_size
            )
            .running({"nonrel_seen": c("nonrel").cast("int")})
            .df
        )
        kept = seen.filter(~c("nonrel") | (c("nonrel_seen") <= c("num_rel")))
        pairs = self.counted(kept)
        groups = counts.join(self.classes.filter("NOT single").select(*_JG).distinct(), _JG)
        return (
            groups.join(pairs, _JG, "left")
            .na.fill(0)
            .select(
                *_JG,
                (c("ful_ret") + c("ful_imp")).alias("ful_cut"),
                (c("poss_ret") + c("poss_imp") + c("poss_none")).alias("poss_cut"),
                c("ful_ret").alias("ful_r_cut"),
                c("poss_ret").alias("poss_r_cut"),
            )
        )

    # -- agreement over judgement groups ------------------------------------------

    def profiles(self) -> DataFrame:
        """(qid, docno, who, doc_rank, retrieved): documents with the name of their profile, the
        classes that they have in all groups of the topic."""
        if self._profiles is None:
            documents = self.judged.groupBy("qid", "docno").agg(
                F.array_sort(F.collect_list(F.struct("jg", "class"))).alias("profile"),
                F.first("doc_rank").alias("doc_rank"),
                F.first("retrieved").alias("retrieved"),
            )
            names = documents.groupBy("qid", "profile").agg(
                F.min("doc_rank").alias("who"), F.count("*").alias("n")
            )
            self._names = durable(names)
            self._profiles = durable(documents.join(self._names.drop("n"), ["qid", "profile"]).drop("profile"))
        return self._profiles

    def _by_profiles(self) -> tuple[DataFrame, DataFrame]:
        """Group tags of every profile, and the topics in which comparing profiles is cheaper.

        (qid, who, n, groups): per group the tags of the profile. Combinations of tags
        take a row for each document and combination, profiles one for each document and profile.
        """
        self.profiles()
        tags = self.tags().groupBy(*_JG, "class").agg(
            F.collect_list(F.struct("tag", F.when(F.col("hi"), "+").otherwise("-").alias("side"))).alias("tags")
        )
        groups = (
            self._names.select("qid", "who", "n", F.inline("profile"))
            .join(tags, [*_JG, "class"])
            .groupBy("qid", "who", "n")
            .agg(F.array_sort(F.collect_list(F.struct("jg", "tags"))).alias("groups"))
        )
        groups = durable(groups)
        sizes = F.aggregate(F.transform("groups", lambda g: F.size(g["tags"]) + 1.0), F.lit(1.0), lambda x, y: x * y)
        costs = groups.groupBy("qid").agg(
            F.sum(F.col("n") * sizes).alias("tag_rows"), (F.sum("n") * F.count("*")).alias("profile_rows")
        )
        return groups, costs.filter("tag_rows > greatest(profile_rows, 1000)").select("qid")

    def agreement(self) -> DataFrame:
        """(qid, c, c_back, ret, imp, none): ordered pairs of documents of which the first ranks above,
        is preferred by ``c`` groups and dispreferred by ``c_back``, per area; pairs without any
        preference are left out."""
        if self._agreement is None:
            groups, crossed = self._by_profiles()
            crossed = durable(crossed)
            none = crossed.isEmpty()
            combined = groups if none else groups.join(crossed, "qid", "left_anti")
            counts = self._exact_counts(self._moments(combined))
            if not none:
                counts = counts.unionByName(self._compared(crossed))
            self._agreement = durable(counts)
        return self._agreement

    def _moments(self, groups: DataFrame) -> DataFrame:
        """(qid, p, q, areas): over all pairs, in how many ways p groups that prefer the first and q others
        that prefer the second can be picked."""
        start = F.array(F.struct(F.lit("").alias("key"), F.lit("").alias("sides")))

        def extended(found: Column, group: Column) -> Column:
            more = F.transform(
                found,
                lambda f: F.transform(
                    group["tags"],
                    lambda t: F.struct(
                        F.concat(f["key"], F.lit("|"), group["jg"], F.lit("="), t["tag"]).alias("key"),
                        F.concat(f["sides"], t["side"]).alias("sides"),
                    ),
                ),
            )
            return F.concat(found, F.flatten(more))

        combinations = groups.select(
            "qid", "who", F.inline(F.aggregate("groups", start, extended))
        ).filter("key <> ''")
        # Partners have the opposite sides; the first side tells the two apart.
        hi = F.col("sides").startswith("+")
        opposite = F.translate("sides", "+-", "-+")
        rows = (
            self.profiles()
            .select("qid", "who", "doc_rank", "retrieved")
            .join(combinations, ["qid", "who"])
            .select(
                "qid", "key", F.when(hi, F.col("sides")).otherwise(opposite).alias("sides"), "doc_rank", "retrieved", hi.alias("hi")
            )
        )
        seen = _pairs_in_order(rows, ["qid", "key", "sides"], self.topic_size)
        sums = seen.groupBy("qid", "sides").agg(
            *[F.sum(f"{way}_{area}").alias(f"{way}_{area}") for way in ("ful", "back") for area in AREAS]
        )
        up = F.length(F.regexp_replace("sides", "-", ""))
        down = F.length("sides") - up
        both = F.array(
            F.struct(up.alias("p"), down.alias("q"), *[F.col(f"ful_{a}").alias(a) for a in AREAS]),
            F.struct(down.alias("p"), up.alias("q"), *[F.col(f"back_{a}").alias(a) for a in AREAS]),
        )
        flat = sums.select("qid", F.inline(both))
        return flat.groupBy("qid", "p", "q").agg(*[F.sum(a).alias(a) for a in AREAS])

    @staticmethod
    def _exact_counts(moments: DataFrame) -> DataFrame:
        """Pairs of exact counts from the numbers of ways to pick groups (binomial inversion)."""
        c, d = F.col("c"), F.col("c_back")
        rows = moments.select("*", F.explode(F.sequence(F.lit(0), F.col("p"))).alias("c"))
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("q"))).alias("c_back")).filter("c + c_back > 0")
        sign = F.when((F.col("p") - c + F.col("q") - d) % 2 == 0, 1).otherwise(-1)
        factor = sign * _choose(F.col("p"), c) * _choose(F.col("q"), d)
        exact = rows.groupBy("qid", "c", "c_back").agg(*[F.sum(factor * F.col(a)).alias(a) for a in AREAS])
        return exact.select(
            "qid", c.cast("long").alias("c"), d.cast("long").alias("c_back"), *[F.col(a).cast("long").alias(a) for a in AREAS]
        ).filter(" + ".join(AREAS) + " > 0")

    def _compared(self, topics: DataFrame) -> DataFrame:
        """The same as :meth:`agreement` by comparing the profiles of the topics."""
        documents = self.profiles().join(topics, "qid", "left_semi")
        memberships = self._names.join(topics, "qid", "left_semi").select("qid", "who", F.inline("profile"))
        lower = memberships.select("qid", "jg", F.col("who").alias("low"), F.col("class").alias("below"))
        counted = (
            memberships.join(self.relation(), ["qid", "jg", "class"])
            .join(lower, ["qid", "jg", "below"])
            .groupBy("qid", "who", "low")
            .agg(F.count("*").alias("c"))
        )
        back = counted.select(
            "qid", F.col("who").alias("low"), F.col("low").alias("who"), F.col("c").alias("c_back")
        )
        both = counted.join(back, ["qid", "who", "low"], "full").na.fill(0)
        hi = documents.join(both, ["qid", "who"]).select(
            "qid", "low", "c", "c_back", "doc_rank", "retrieved", F.lit(True).alias("hi")
        )
        lows = both.select("qid", F.col("low").alias("who"), "c", "c_back").distinct()
        lo = documents.join(lows, ["qid", "who"]).select(
            "qid", F.col("who").alias("low"), "c", "c_back", "doc_rank", "retrieved", F.lit(False).alias("hi")
        )
        seen = _pairs_in_order(hi.unionByName(lo), ["qid", "low", "c", "c_back"], None)
        counts = seen.groupBy("qid", "c", "c_back").agg(*[F.sum(f"ful_{a}").alias(a) for a in AREAS])
        return counts.filter(" + ".join(AREAS) + " > 0")

    def pair_counts(self) -> DataFrame:
        """(qid, c, c_back, pairs): how many ordered document pairs are preferred by ``c``
        groups and dispreferred by ``c_back``."""
        n = F.expr(" + ".join(AREAS)).alias("pairs")
        found = self.agreement().select("qid", "c", "c_back", n)
        back = found.select("qid", F.col("c_back").alias("c"), F.col("c").alias("c_back"), "pairs")
        both = found.unionByName(back).filter("c > 0")
        return both.groupBy("qid", "c", "c_back").agg(F.sum("pairs").alias("pairs"))

    def pair_sums(self) -> DataFrame:
        """Per topic: sums of pair ratios and numbers of judged pairs, by retrieval area."""
        weight = F.col("c") / (F.col("c") + F.col("c_back"))
        return self.agreement().groupBy("qid").agg(
            *[F.sum(a).alias(f"pairs_{a}") for a in AREAS],
            F.sum(weight * F.col("ret")).alias("sum_ret"),
            F.sum(weight * F.col("imp")).alias("sum_imp"),
        )


def _summed_size(rows: DataFrame, keys: list[str]) -> GroupSize:
    """Documents in the largest group and in all, from numbers ``n`` of documents."""
    largest, total = rows.groupBy(*keys).agg(F.sum("n").alias("n")).agg(F.max("n"), F.sum("n")).first()
    return GroupSize(largest or 0, total or 0)


def _member_conflicts(judged: DataFrame) -> DataFrame:
    """The rows of ``preference_conflicts`` from the members of the documents of each group."""
    levels = F.filter("members", lambda m: m["level"].isNotNull())
    levels = F.transform(levels, lambda m: F.struct(m["jsg"].alias("jsg"), (m["level"] + 0.0).alias("level")))
    different, subs = F.array_distinct(levels), F.array_distinct(F.transform(levels, lambda m: m["jsg"]))
    zero = F.exists(levels, lambda m: m["level"] == 0) & F.exists(levels, lambda m: m["level"] > 0)
    rules = F.array(
        F.when(F.size(different) > F.size(subs), "two levels"), F.when(zero, "zero and non-zero")
    )
    several = judged.filter(F.size("members") > 1)
    return several.select("qid", "jg", "docno", F.explode(F.array_compact(rules)).alias("rule"))


def preference_errors(prefs: DataFrame) -> DataFrame:
    """(qid, jg, docno, rule): documents judged inconsistently. To the rules of
    ``preference_conflicts`` comes ``contradiction``: preferred to itself after closure."""
    every = prefs.select("qid", "docno").distinct().withColumn("score", F.lit(0.0))
    tables = Preferences(every, prefs)
    cycles = tables.contradictions().distinct().join(tables.judged, [*_JG, "class"])
    rows = cycles.select(*_JG, "docno", F.lit("contradiction").alias("rule"))
    return preference_conflicts(prefs).unionByName(rows)


def _choose(n: Column, k: Column) -> Column:
    """Binomial coefficient; exact while it fits a double."""
    product = F.aggregate(F.sequence(F.lit(1), k), F.lit(1.0), lambda x, i: x * (n - k + i) / i)
    return F.when(k == 0, 1.0).otherwise(F.round(product))


def _pairs_in_order(rows: DataFrame, keys: list[str], size: Size) -> DataFrame:
    """Pairs of an upper (``hi``) and a lower row of a group, counted at the one that ranks below.

    Adds ``ful_*`` (the upper row ranks above) and ``back_*`` (the lower one does) per area: both
    retrieved, the first alone, none. Retrieved documents rank above others.
    """
    hi, ret = F.col("hi"), F.col("retrieved")
    sums = {
        f"{side}_{kind}": F.when(is_side & is_kind, 1).otherwise(0)
        for side, is_side in (("hi", hi), ("lo", ~hi))
        for kind, is_kind in (("ret", ret), ("un", ~ret))
    }
    df = OrderedGroups(rows, keys, [F.col("doc_rank")], size).running(sums).df

    def at(is_side: Column, is_kind: Column, seen: str) -> Column:
        return F.when(is_side & is_kind, F.col(seen)).otherwise(0)

    return df.withColumns(
        {
            f"{way}_{area}": at(here, is_kind, f"{side}_{kind}")
            for way, here, side in (("ful", ~hi, "hi"), ("back", hi, "lo"))
            for area, is_kind, kind in (("ret", ret, "ret"), ("imp", ~ret, "ret"), ("none", ~ret, "un"))
        }
    )


def _mean_ratio(top: str, bottom: str) -> str:
    return f"avg({ratio(top, bottom)})"


def _balanced_mean(top: str, bottom: str) -> str:
    # A group without any preference makes the value of the whole topic 0.
    return f"if(max({bottom} = 0), 0D, avg({ratio(top, bottom)}))"


# Preference measures as SQL over the counts of a topic's groups ...
_FUL, _SEEN = "(ful_ret + ful_imp)", "(poss_ret + poss_imp)"
_POSS = "(poss_ret + poss_imp + poss_none)"
_BY_GROUP = {
    "prefs_num_prefs_poss": f"sum{_POSS}",
    "prefs_num_prefs_ful": f"sum{_FUL}",
    "prefs_num_prefs_ful_ret": "sum(ful_ret)",
    "prefs_simp": ratio(f"sum{_FUL}", f"sum{_POSS}"),
    "prefs_simp_ret": ratio("sum(ful_ret)", "sum(poss_ret)"),
    "prefs_simp_imp": ratio(f"sum{_FUL}", f"sum{_SEEN}"),
    "prefs_avgjg": _mean_ratio(_FUL, _POSS),
    "prefs_avgjg_ret": _mean_ratio("ful_ret", "poss_ret"),
    "prefs_avgjg_imp": _mean_ratio(_FUL, _SEEN),
}
# ... over the balanced counts of its groups ...
_BY_BALANCE = {
    "prefs_avgjg_Rnonrel": _balanced_mean("ful", "poss"),
    "prefs_avgjg_Rnonrel_ret": _balanced_mean("ful_r", "poss_r"),
}
# ... and over its pair sums.
_BY_PAIR = {
    "prefs_pair": ratio("sum_ret + sum_imp", "pairs_ret + pairs_imp + pairs_none"),
    "prefs_pair_ret": ratio("sum_ret", "pairs_ret"),
    "prefs_pair_imp": ratio("sum_ret + sum_imp", "pairs_ret + pairs_imp"),
}


def pref_values(
    run: DataFrame,
    prefs: DataFrame,
    wanted: Sequence[str],
    max_docs: int | None = None,
    strict: bool = False,
    size: Size = None,
) -> DataFrame:
    """(qid, measure, value) of the wanted preference measures."""
    tables = Preferences(run, prefs, max_docs, size, checked=True).check()
    parts = []
    sources = [
        (_BY_GROUP, tables.group_counts),
        (_BY_BALANCE, lambda: tables.balanced_counts(strict)),
    ]
    for formulas, table in sources:
        names = [n for n in wanted if n in formulas]
        if names:
            topics = table().groupBy("qid").agg(*[F.expr(f"{formulas[n]} AS {n}") for n in names])
            parts.append(long_form(topics, ["qid"], [(n, n) for n in names]))
    names = [n for n in wanted if n in _BY_PAIR]
    if names:
        topics = tables.judged.select("qid").distinct().join(tables.pair_sums(), "qid", "left").na.fill(0)
        parts.append(long_form(topics, ["qid"], [(n, _BY_PAIR[n]) for n in names]))
    if not parts:
        raise ValueError("no preference measure chosen")
    return reduce(DataFrame.unionByName, parts)
