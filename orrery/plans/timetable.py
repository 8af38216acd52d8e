"""Timetable group. Enrolments: student = l_orderkey, course = l_partkey (distinct).
Assignments: every part is a course with lessons 0 and 1;
room = (p_partkey·31 + lesson·17) mod n_rooms, slot = (p_partkey·7 + lesson·3) mod 25,
n_rooms = ceil(#courses / 10), so the number of rooms grows with the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import split as sp
from orrery.operators import timetable as tt
from orrery.operators.scalar_join import attach_scalar
from orrery.plans.common import rnd
from orrery.sources.tables import Tables

N_CANDIDATES = 100
COURSES_PER_ROOM = 10
SEED = 42


def enrolments(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select(F.col("l_orderkey").alias("student"), F.col("l_partkey").alias("course")).distinct()


def rooms(spark, sf):
    p = Tables(spark, sf).part
    return p.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / COURSES_PER_ROOM)).cast("int").alias("n_rooms"))


def assignments(spark, sf):
    p = Tables(spark, sf).part.select(F.col("p_partkey").alias("course"))
    a = attach_scalar(p, rooms(spark, sf)).select("course", "n_rooms", F.explode(F.array(F.lit(0), F.lit(1))).alias("lesson"))
    return a.select("course", "lesson",
                    F.pmod(F.col("course") * 31 + F.col("lesson") * 17, F.col("n_rooms")).cast("int").alias("room"),
                    F.pmod(F.col("course") * 7 + F.col("lesson") * 3, F.lit(tt.N_SLOTS)).cast("int").alias("slot"))


def base_grid(spark, sf):
    return tt.grid(assignments(spark, sf), rooms(spark, sf))


def scores(spark, sf):
    return tt.candidate_scores(base_grid(spark, sf), tt.slot_permutations(spark, N_CANDIDATES, SEED))


def best_grid(spark, sf):
    moves = tt.slot_permutations(spark, N_CANDIDATES, SEED)
    return tt.permuted_grid(base_grid(spark, sf), moves, tt.best_candidate(scores(spark, sf)))


def q_conflict_pairs(spark, sf):
    return tt.conflict_edges(enrolments(spark, sf))


def q_conflict_sets(spark, sf):
    s = tt.conflict_sets(tt.conflict_edges(enrolments(spark, sf)))
    return s.select(F.col("course_a").alias("course"), F.col("n_conflicts").cast("long").alias("n_conflicts"),
                    F.array_join(F.transform("conflicts", lambda x: x.cast("string")), ",").alias("conflicts"))


def q_conflict_bitmaps(spark, sf):
    e = enrolments(spark, sf)
    return tt.conflict_bitmaps(tt.conflict_edges(e), tt.pair_tasks(e)).select("course", "bucket", "n_conflicts", F.lower(F.md5("bitmap")).alias("bitmap_md5"))


def q_check_room_overlap(spark, sf):
    return tt.room_overlaps(assignments(spark, sf))


def q_check_conflicts(spark, sf):
    return tt.conflict_violations(enrolments(spark, sf), assignments(spark, sf))


def q_check_precedence(spark, sf):
    return tt.precedence_violations(assignments(spark, sf))


def q_soft_score(spark, sf):
    s = tt.soft_terms(base_grid(spark, sf))
    return s.select("adjacent_pairs", "free_afternoons", rnd("score", 6).alias("score"))


def q_best_candidate(spark, sf):
    b = tt.best_candidate(scores(spark, sf))
    return b.select(F.col("candidate").cast("int").alias("candidate"), rnd("score", 6).alias("score"),
                    "adjacent_pairs", "free_afternoons")


def q_student_timetable(spark, sf):
    e = enrolments(spark, sf)
    who = sp.pick_one(e.select("student").distinct(), "student", SEED)
    return tt.student_grid(best_grid(spark, sf), e, who)


def q_slot_occupancy(spark, sf):
    before = tt.occupancy(base_grid(spark, sf)).withColumnRenamed("occupied_pct", "occ_before")
    after = tt.occupancy(best_grid(spark, sf)).withColumnRenamed("occupied_pct", "occ_after")
    return before.join(after, "slot").select("slot", rnd("occ_before", 6).alias("occ_before"),
                                             rnd("occ_after", 6).alias("occ_after"))


QUERIES = {
    "conflict_pairs": q_conflict_pairs,
    "conflict_sets": q_conflict_sets,
    "conflict_bitmaps": q_conflict_bitmaps,
    "check_room_overlap": q_check_room_overlap,
    "check_conflicts": q_check_conflicts,
    "check_precedence": q_check_precedence,
    "soft_score": q_soft_score,
    "best_candidate": q_best_candidate,
    "student_timetable": q_student_timetable,
    "slot_occupancy": q_slot_occupancy,
}

BASE_SQL = f"""enrol AS (SELECT DISTINCT l_orderkey AS student, l_partkey AS course FROM lineitem),
edges AS (SELECT DISTINCT a.course AS course_a, b.course AS course_b FROM enrol a JOIN enrol b
  ON a.student = b.student AND a.course <> b.course),
nr AS (SELECT CAST(greatest(1, ceil(count(*) / {COURSES_PER_ROOM})) AS INTEGER) AS n_rooms FROM part),
asg AS (SELECT p_partkey AS course, lesson, CAST((p_partkey * 31 + lesson * 17) % n_rooms AS INTEGER) AS room,
  CAST((p_partkey * 7 + lesson * 3) % 25 AS INTEGER) AS slot FROM part, nr, (VALUES (0), (1)) l(lesson)),
cells AS (SELECT CAST(r.room AS INTEGER) AS room, CAST(s.slot AS INTEGER) AS slot
  FROM (SELECT unnest(range(n_rooms)) AS room FROM nr) r, range(25) s(slot)),
occ AS (SELECT room, slot, min(course) AS c FROM asg GROUP BY 1, 2),
grid AS (SELECT cells.room, cells.slot, coalesce(CAST(c AS VARCHAR), '*') AS content
  FROM cells LEFT JOIN occ USING (room, slot)),
perm AS (SELECT CAST(k.candidate AS INTEGER) AS candidate, CAST(s.slot AS INTEGER) AS slot,
  CAST(row_number() OVER (PARTITION BY k.candidate ORDER BY CASE WHEN k.candidate >= 0 THEN
    md5('{SEED}:' || CAST(k.candidate AS VARCHAR) || ':' || CAST(s.slot AS VARCHAR)) END, s.slot) - 1 AS INTEGER) AS new_slot
  FROM range(-1, {N_CANDIDATES}) k(candidate), range(25) s(slot)),
cand AS (SELECT candidate, room, new_slot AS slot, content FROM grid JOIN perm USING (slot)),
ct AS (SELECT *, lead(content) OVER (PARTITION BY candidate, room, slot // 5 ORDER BY slot) AS nxt FROM cand),
sc AS (SELECT candidate, count(*) FILTER (WHERE slot % 5 <> 4 AND content = nxt) AS adjacent_pairs,
  count(*) FILTER (WHERE slot % 5 >= 3 AND content = '*') AS free_afternoons FROM ct GROUP BY candidate),
sc2 AS (SELECT *, CAST(adjacent_pairs AS DOUBLE) * 0.1 + CAST(free_afternoons AS DOUBLE) * 1.0 AS score FROM sc),
best AS (SELECT * FROM sc2 ORDER BY score DESC, candidate LIMIT 1),
bgrid AS (SELECT room, slot, content FROM cand WHERE candidate = (SELECT candidate FROM best))"""

_DAYS = ", ".join(f"coalesce(max(cell) FILTER (WHERE day = '{d}'), '*') AS {d}" for d in tt.DAYS)
_DAYS_ARR = "[" + ", ".join(f"'{d}'" for d in tt.DAYS) + "]"
_PER_ARR = "[" + ", ".join(f"'{p}'" for p in tt.PERIODS) + "]"

ORACLE = {
    "conflict_pairs": f"WITH {BASE_SQL} SELECT course_a, course_b FROM edges",
    "conflict_sets": f"""WITH {BASE_SQL}
SELECT course_a AS course, count(*) AS n_conflicts,
  array_to_string(list_transform(list_sort(list(course_b)), lambda x: CAST(x AS VARCHAR)), ',') AS conflicts
FROM edges GROUP BY course_a""",
    "conflict_bitmaps": f"""WITH {BASE_SQL},
bt AS (SELECT course_a AS course, CAST(course_b // 32768 + 1 AS BIGINT) AS bucket, course_b % 32768 // 8 AS pos, bit_or(1 << CAST(course_b % 8 AS INTEGER)) AS byte,
         count(*) AS n FROM edges GROUP BY ALL),
g AS (SELECT course, bucket, CAST(sum(n) AS BIGINT) AS n_conflicts, map(list(pos), list(byte)) AS bytes FROM bt GROUP BY ALL)
SELECT course, bucket, n_conflicts,
  md5(unhex(list_aggregate(list_transform(range(4096), lambda i: printf('%02x', coalesce(bytes[i], 0))), 'string_agg', ''))) AS bitmap_md5 FROM g""",
    "check_room_overlap": f"""WITH {BASE_SQL}
SELECT room, slot, count(*) AS n_lessons FROM asg GROUP BY room, slot HAVING count(*) > 1""",
    "check_conflicts": f"""WITH {BASE_SQL}
SELECT e.course_a, a.lesson AS lesson_a, e.course_b, b.lesson AS lesson_b, a.slot
FROM edges e JOIN asg a ON a.course = e.course_a JOIN asg b ON b.course = e.course_b AND b.slot = a.slot
WHERE e.course_a < e.course_b""",
    "check_precedence": f"""WITH {BASE_SQL}
SELECT course, lesson, slot, next_lesson, next_slot FROM (
  SELECT *, lead(slot) OVER (PARTITION BY course ORDER BY lesson) AS next_slot,
            lead(lesson) OVER (PARTITION BY course ORDER BY lesson) AS next_lesson FROM asg)
WHERE next_slot < slot + 1""",
    "soft_score": f"""WITH {BASE_SQL}
SELECT adjacent_pairs, free_afternoons, round(score, 6) AS score FROM sc2 WHERE candidate = -1""",
    "best_candidate": f"""WITH {BASE_SQL}
SELECT candidate, round(score, 6) AS score, adjacent_pairs, free_afternoons FROM best""",
    "student_timetable": f"""WITH {BASE_SQL},
who AS (SELECT student FROM (SELECT DISTINCT student FROM enrol)
        ORDER BY md5('{SEED}' || CAST(student AS VARCHAR)), student LIMIT 1),
mine AS (SELECT * FROM bgrid WHERE content IN (
  SELECT CAST(course AS VARCHAR) FROM enrol WHERE student = (SELECT student FROM who))),
m AS (SELECT {_DAYS_ARR}[slot // 5 + 1] AS day, {_PER_ARR}[slot % 5 + 1] AS period,
        content || '@' || CAST(room AS VARCHAR) AS cell FROM mine),
per AS (SELECT unnest({_PER_ARR}) AS period)
SELECT per.period, {_DAYS} FROM per LEFT JOIN m USING (period) GROUP BY per.period""",
    "slot_occupancy": f"""WITH {BASE_SQL},
b AS (SELECT slot, count(*) FILTER (WHERE content <> '*') * 100.0 / count(*) AS occ_before FROM grid GROUP BY slot),
a AS (SELECT slot, count(*) FILTER (WHERE content <> '*') * 100.0 / count(*) AS occ_after FROM bgrid GROUP BY slot)
SELECT slot, round(occ_before, 6) AS occ_before, round(occ_after, 6) AS occ_after FROM b JOIN a USING (slot)""",
}
