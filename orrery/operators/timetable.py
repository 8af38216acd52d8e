"""Timetable analytics (survey T1-T8, C5, C8, D5, D13, D14, E5, G10).

The solver itself is not built; these are the data operations around it, each a
Spark job over long tables:

* enrolments(student, course)        → conflict edges by a self join on student
* assignments(course, lesson, room, slot) → hard-constraint checks as group-bys/joins
* grid(room, slot, course | '*')     → soft score with ``lead`` inside (room, day)
* candidates = slot permutations      → scored from one table of equal slot pairs

Slots are numbered day-major: slot = day * periods + period.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.skew import salted_self_join
from orrery.session import cut_lineage

FREE = "*"
# Week layout of the timetable.
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
PERIODS = ["8-10", "10-12", "12-14", "14-16", "16-18"]
N_SLOTS = len(DAYS) * len(PERIODS)
ADJ_BONUS = 0.1          # same content in two adjacent periods of a day
FREE_AFTERNOON = 1.0     # a free room in one of the last two periods of a day


PAIRS = 500_000  # pairs that one task makes distinct
TASKS = 10_000  # at most


def pair_tasks(enrol: DataFrame, student: str = "student") -> int:
    """Tasks for the pairs of courses of distinct enrolments: their number grows with the pairs."""
    n = enrol.filter(F.col(student).isNotNull()).groupBy(student).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0]
    return min(TASKS, max(1, math.ceil((n or 0) / PAIRS)))


def conflict_edges(enrol: DataFrame, student: str = "student", course: str = "course",
                   salt_threshold: int = 10_000) -> DataFrame:
    """Distinct ordered pairs (course_a, course_b), a != b, of courses sharing at
    least one student (both directions, irreflexive). Enrolments are deduplicated
    first; students with more than ``salt_threshold`` courses are split by
    size so one hot student does not produce all its pairs in one task. Pairs are formed
    and deduplicated in one direction and turned round afterwards; as many tasks as the
    pairs ask for deduplicate, each about ``PAIRS`` of them."""
    # both join sides and the heavy-key count read the deduplicated enrolments
    e = cut_lineage(enrol.select(F.col(student).alias("_s"), F.col(course).alias("_c")).distinct())
    left, right = salted_self_join(e, e, "_s", "_c", salt_threshold)
    a = left.select("_s", "_salt", F.col("_c").alias("course_a"))
    b = right.select("_s", "_salt", F.col("_c").alias("course_b"))
    half = a.join(b, ["_s", "_salt"]).filter(F.col("course_a") < F.col("course_b")).select("course_a", "course_b")
    half = half.repartition(pair_tasks(e, "_s"), "course_a", "course_b").distinct()
    both = F.explode(F.array(F.struct("course_a", "course_b"), F.struct(F.col("course_b").alias("course_a"), F.col("course_a").alias("course_b"))))
    return half.select(both.alias("p")).select("p.*")


def conflict_sets(edges: DataFrame) -> DataFrame:
    """course → sorted set of conflicting courses (and its size)."""
    return edges.groupBy("course_a").agg(F.array_sort(F.collect_set("course_b")).alias("conflicts")) \
                .withColumn("n_conflicts", F.size("conflicts"))


def conflict_bitmaps(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """(course, bucket, n_conflicts, bitmap): the courses in conflict with each course as
    bitmaps of 32,768 ids (0 and above; bucket b holds the ids from 32768 (b - 1) on), so that a
    course in conflict with millions of others is many rows of 4 KB instead of one set.
    Edges are dealt by (course, bucket) to ``tasks`` (else as many as the session shuffles to)
    before a bitmap is built, so that no bitmaps are shuffled or sorted."""
    at = F.col("course_b") + 1
    by = edges.select(F.col("course_a").alias("course"), F.bitmap_bucket_number(at).alias("bucket"), "course_b")
    by = by.repartition("course", "bucket") if tasks is None else by.repartition(tasks, "course", "bucket")
    return (by.groupBy("course", "bucket")
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
                 .select("course", "bucket", F.bitmap_count("bitmap").alias("n_conflicts"), "bitmap"))


def bitmap_members(bitmaps: DataFrame) -> DataFrame:
    """(course_a, course_b): the edges that ``conflict_bitmaps`` holds."""
    by = bitmaps.select("course", "bucket", F.posexplode(F.split(F.regexp_replace(F.hex("bitmap"), "(..)(?!$)", "$1,"), ",")).alias("at", "byte"))
    by = by.filter(F.col("byte") != "00").withColumn("byte", F.conv("byte", 16, 10).cast("int"))
    bits = by.select("course", "bucket", "at", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    bits = bits.filter(F.expr("(byte >> bit) & 1 = 1"))
    return bits.select(F.col("course").alias("course_a"), ((F.col("bucket") - 1) * 32768 + F.col("at") * 8 + F.col("bit")).alias("course_b"))


def room_overlaps(assign: DataFrame) -> DataFrame:
    """Hard constraint: a room holds at most one lesson per slot."""
    return (assign.groupBy("room", "slot").agg(F.count(F.lit(1)).alias("n_lessons"))
                  .filter(F.col("n_lessons") > 1))


def conflict_violations(enrol: DataFrame, assign: DataFrame, student: str = "student", course: str = "course",
                        salt_threshold: int = 10_000) -> DataFrame:
    """Hard constraint: courses that share a student never share a slot (any lesson pair).
    (course_a, lesson_a, course_b, lesson_b, slot), course_a < course_b, each once.

    A student's lessons are paired by (student, slot), so a pair of courses arises only where
    its lessons collide, not for every two courses of a student. The pairs of a student and
    slot with more than ``salt_threshold`` lessons are split by size.
    """
    lessons = enrol.select(F.col(student).alias("_s"), F.col(course).alias("course")).distinct().join(assign.select("course", "lesson", "slot"), "course")
    at = cut_lineage(lessons.select(F.struct("_s", "slot").alias("_k"), "course", "lesson"))
    left, right = salted_self_join(at, at, "_k", F.hash("course", "lesson"), salt_threshold)
    a = left.select("_k", "_salt", F.col("course").alias("course_a"), F.col("lesson").alias("lesson_a"))
    b = right.select("_k", "_salt", F.col("course").alias("course_b"), F.col("lesson").alias("lesson_b"))
    return (a.join(b, ["_k", "_salt"]).filter(F.col("course_a") < F.col("course_b"))
             .select("course_a", "lesson_a", "course_b", "lesson_b", F.col("_k.slot").alias("slot")).distinct())


def precedence_violations(assign: DataFrame, duration: int = 1) -> DataFrame:
    """Each next lesson of a course must start at or after the previous one ends."""
    w = Window.partitionBy("course").orderBy("lesson")
    nxt = assign.withColumn("next_slot", F.lead("slot").over(w)).withColumn(
        "next_lesson", F.lead("lesson").over(w))
    return nxt.filter(F.col("next_slot") < F.col("slot") + duration).select(
        "course", "lesson", "slot", "next_lesson", "next_slot")


def grid(assign: DataFrame, rooms: DataFrame) -> DataFrame:
    """(room, slot, content): the lowest course assigned to the cell, '*' if none.
    ``rooms`` is a one-row frame with ``n_rooms``; the cells are generated by a
    distributed ``range`` over rooms (one scalar read), each room row exploding
    into its slots, so no task builds the whole grid."""
    spark = assign.sparkSession
    n_rooms = int(rooms.first()["n_rooms"])
    all_cells = spark.range(n_rooms).select(F.col("id").cast("int").alias("room"),
                                            F.explode(F.sequence(F.lit(0), F.lit(N_SLOTS - 1))).alias("slot"))
    occupied = assign.groupBy("room", "slot").agg(F.min("course").alias("_c"))
    return (all_cells.join(occupied, ["room", "slot"], "left")
                     .select("room", "slot", F.coalesce(F.col("_c").cast("string"), F.lit(FREE)).alias("content")))


def soft_terms(g: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per (keys): adjacency pairs and free afternoon cells, and the soft score
    0.1 · pairs + 1 · free afternoons (equal free cells count as a pair)."""
    keys = keys or []
    w = Window.partitionBy(*keys, "room", (F.col("slot") / len(PERIODS)).cast("int")).orderBy("slot")
    period = F.col("slot") % len(PERIODS)
    t = g.withColumn("_next", F.lead("content").over(w))
    adj = F.count_if((period != len(PERIODS) - 1) & (F.col("content") == F.col("_next")))
    free = F.count_if((period >= len(PERIODS) - 2) & (F.col("content") == FREE))
    return (t.groupBy(*keys).agg(adj.alias("adjacent_pairs"), free.alias("free_afternoons"))
             .withColumn("score", F.col("adjacent_pairs") * ADJ_BONUS + F.col("free_afternoons") * FREE_AFTERNOON))


def equal_pairs(g: DataFrame) -> DataFrame:
    """slot_a, slot_b (a < b), n_equal: the rooms whose content is the same in both slots, and
    for slot_a = slot_b the rooms that are free in it. At most N_SLOTS² / 2 rows, whatever the
    grid: a room's slots are paired within the room only."""
    rooms = g.groupBy("room").agg(F.collect_list(F.struct("slot", "content")).alias("_s"))  # N_SLOTS cells a room
    cells = rooms.select("_s", F.explode("_s").alias("_a"))
    same = cells.select(F.col("_a.slot").alias("slot_a"), F.explode(F.filter("_s", lambda o: F.when(
        o["slot"] == F.col("_a.slot"), o["content"] == FREE).otherwise((o["slot"] > F.col("_a.slot")) & (o["content"] == F.col("_a.content"))))).alias("_o"))
    return same.groupBy("slot_a", F.col("_o.slot").alias("slot_b")).agg(F.count(F.lit(1)).alias("n_equal"))


def slot_permutations(spark, n_candidates: int = 100, seed: int = 42) -> DataFrame:
    """(candidate, slot, new_slot): candidate c orders the slots by md5(seed : c : slot), so any
    permutation may occur; candidate -1 leaves every slot where it is."""
    cand = spark.range(-1, n_candidates).select(F.col("id").cast("int").alias("candidate"))
    cells = cand.select("candidate", F.explode(F.sequence(F.lit(0), F.lit(N_SLOTS - 1))).alias("slot"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("candidate").cast("string"), F.col("slot").cast("string")))
    w = Window.partitionBy("candidate").orderBy(F.when(F.col("candidate") >= 0, key), "slot")
    return cells.withColumn("new_slot", (F.row_number().over(w) - 1).cast("int"))


def candidate_scores(g: DataFrame, permutations: DataFrame) -> DataFrame:
    """candidate, adjacent_pairs, free_afternoons, score of the grid with its slots permuted.

    ``equal_pairs`` scores any permutation: two slots that it moves next to each other add
    their equal rooms, a slot that it moves into an afternoon its free rooms. So the grid is
    read once, and candidates cost N_SLOTS rows each instead of a copy of the grid.
    """
    at = permutations.select("candidate", F.col("slot").alias("_s"), F.col("new_slot").alias("_n"))
    first = at.select("candidate", F.col("_s").alias("_sa"), F.col("_n").alias("_na"))
    periods = len(PERIODS)
    period = F.pmod("_n", F.lit(periods))
    afternoons = at.filter(period >= periods - 2).select("candidate", F.col("_s").alias("slot_a"), F.col("_s").alias("slot_b"), F.lit(0).alias("_adjacent"))
    following = (first.filter(F.pmod("_na", F.lit(periods)) != periods - 1)
                      .join(at.withColumn("_na", F.col("_n") - 1), ["candidate", "_na"])
                      .select("candidate", F.least("_sa", "_s").alias("slot_a"), F.greatest("_sa", "_s").alias("slot_b"), F.lit(1).alias("_adjacent")))
    table = equal_pairs(g)
    hits = afternoons.unionByName(following).join(table, ["slot_a", "slot_b"], "left")
    n = F.coalesce("n_equal", F.lit(0))
    return (hits.groupBy("candidate").agg(F.sum(n * F.col("_adjacent")).alias("adjacent_pairs"), F.sum(n * (1 - F.col("_adjacent"))).alias("free_afternoons"))
                .withColumn("score", F.col("adjacent_pairs") * ADJ_BONUS + F.col("free_afternoons") * FREE_AFTERNOON))


def permuted_grid(g: DataFrame, permutations: DataFrame, candidate: DataFrame) -> DataFrame:
    """The grid of one candidate (a row with its number): only this one is built."""
    moves = permutations.join(candidate.select("candidate"), "candidate", "left_semi").select("slot", "new_slot")
    return g.join(moves, "slot").select("room", F.col("new_slot").alias("slot"), "content")


def best_candidate(scores: DataFrame) -> DataFrame:
    """Highest score; a candidate replaces the current best only when strictly
    better, so ties go to the earliest candidate (the unchanged grid first)."""
    return scores.agg(F.max_by(F.struct("candidate", "score", "adjacent_pairs", "free_afternoons"),
                               F.struct(F.col("score"), -F.col("candidate"))).alias("b")).select("b.*")


def occupancy(g: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Percent of rooms busy per slot."""
    keys = keys or []
    return g.groupBy(*keys, "slot").agg(
        (F.count_if(F.col("content") != FREE) * 100.0 / F.count(F.lit(1))).alias("occupied_pct"))


def slot_label(slot: Column) -> Column:
    days = F.array(*[F.lit(d) for d in DAYS])
    per = F.array(*[F.lit(p) for p in PERIODS])
    return F.concat_ws(" ", F.element_at(days, (slot / len(PERIODS)).cast("int") + 1),
                       F.element_at(per, (slot % len(PERIODS)).cast("int") + 1))


def student_grid(g: DataFrame, enrol: DataFrame, student_row: DataFrame) -> DataFrame:
    """Weekly grid of one student: rows = period, one column per day, cell =
    'course@room' of a followed course (or '*'). The student's courses come from a
    semi join; the label 'Monday 8-10' is split into day and period."""
    courses = enrol.join(student_row.select("student"), "student", "left_semi").select(
        F.col("course").cast("string").alias("content")).distinct()
    mine = g.join(courses, "content", "left_semi")
    lab = F.split(slot_label(F.col("slot")), " ")
    cellv = F.concat_ws("@", F.col("content"), F.col("room").cast("string"))
    m = mine.select(lab[0].alias("day"), lab[1].alias("period"), cellv.alias("cell"))
    periods = g.sparkSession.createDataFrame([(p,) for p in PERIODS], "period string")
    wide = m.groupBy("period").pivot("day", DAYS).agg(F.max("cell"))
    return periods.join(wide, "period", "left").fillna(FREE, subset=DAYS)
