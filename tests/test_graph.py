import itertools
import random

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from sparkcount.functions.hashing import Affine, EdgeBucket, draw_affine, draw_edge_bucket
from sparkcount.operators import graph as G
from sparkcount.sources.tables import edge_list
from sparkcount.sources.text import read_edges
from conftest import SF001, SF01


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "u BIGINT, v BIGINT")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][0]


def brute(pairs):
    adj = {}
    for u, v in set(pairs):
        if u != v:
            adj.setdefault(u, set()).add(v)
            adj.setdefault(v, set()).add(u)
    return sum(1 for a, b, c in itertools.combinations(sorted(adj), 3)
               if b in adj[a] and c in adj[a] and c in adj[b])


TRI = [(1, 2), (2, 3), (1, 3)]


def test_one_triangle(spark):
    assert one(G.triangle_count(edges(spark, TRI))) == 1


def test_shared_edge(spark):
    assert one(G.triangle_count(edges(spark, TRI + [(2, 4), (3, 4)]))) == 2


def test_loop_and_reversed_copy(spark):
    e = G.distinct_edges(edges(spark, TRI + [(1, 1), (2, 1), (2, 1)]))
    assert one(G.edge_count(e)) == 5
    assert one(G.triangle_count(e)) == 1


def test_no_edges_gives_zero(spark):
    e = edges(spark, [])
    assert one(G.triangle_count(e)) == 0
    assert one(G.approx_triangles_color(e, 4, Affine(3, 5))) == 0
    assert one(G.approx_triangles_partition(e, 4, EdgeBucket(3, 5, 7))) == 0
    assert one(G.exact_triangles_color(e, 4, Affine(3, 5))) == 0
    assert [r.triangles for r in G.triangles_per_partition(e, 3, EdgeBucket(3, 5, 7)).collect()] == [0, 0, 0]
    runs = G.approx_triangles_color_runs(e, 2, [Affine(3, 5), Affine(7, 1)]).orderBy("run").collect()
    assert [r.triangles for r in runs] == [0, 0]


def test_negative_and_large_ids(spark):
    e = edges(spark, [(-5, 8192), (8192, 9000), (-5, 9000)])
    assert one(G.triangle_count(e)) == 1
    colors = G.color_nodes(e, 4, Affine(4321, 777)).collect()
    assert all(0 <= r.color < 4 for r in colors)
    for h in draw_affine(3, 4):
        assert one(G.exact_triangles_color(e, 3, h)) == 1


def test_same_residue_same_color(spark):
    e = edges(spark, [(1, 8192)])
    for h in draw_affine(11, 5):
        for C in (2, 3, 7):
            got = {r.node: r.color for r in G.color_nodes(e, C, h).collect()}
            assert got[1] == got[8192] == ((h.a * 1 + h.b) % h.p) % C


def test_color_formula_matches_python(spark):
    e = edges(spark, [(-123456789, 987654321), (0, 2 ** 40)])
    h = Affine(4321, 777)
    got = {r.node: r.color for r in G.color_nodes(e, 5, h).collect()}
    for n, c in got.items():
        assert c == ((h.a * n + h.b) % h.p) % 5


def test_sf0001_known_answers(spark):
    e = G.distinct_edges(edge_list(spark, SF001))
    assert one(G.edge_count(e)) == 1905
    assert G.undirected(e).count() == 1852
    assert one(G.triangle_count(e)) == 7852


def test_sf001_known_answers(spark):
    e = G.distinct_edges(edge_list(spark, SF01))
    assert one(G.triangle_count(e)) == 300177
    assert one(G.approx_triangles_color(e, 4, Affine(4321, 777))) == 292480
    runs = [Affine(1000 + 37 * i, 11 * i) for i in range(1, 6)]
    per_run = sorted(r.triangles for r in G.approx_triangles_color_runs(e, 4, runs).collect())
    assert per_run == [269920, 279808, 298048, 302032, 307312]
    assert one(G.approx_triangles_color_median(e, 4, runs)) == 298048.0
    assert one(G.approx_triangles_partition(e, 4, EdgeBucket(4321, 777, 5))) == 321072


@pytest.mark.parametrize("C", [1, 2, 4, 8])
def test_exact_by_color_equals_exact(spark, C):
    e = G.distinct_edges(edge_list(spark, SF001))
    h = draw_affine(C, 1)[0]
    assert one(G.exact_triangles_color(e, C, h)) == 7852
    assert one(G.exact_triangles_color(e, C, h, "replicate")) == 7852


def test_group_count_and_replication(spark):
    e = G.distinct_edges(edge_list(spark, SF001))
    h = Affine(4321, 777)
    for C, groups in ((2, 4), (4, 20)):
        per = G.triangles_per_color_triple(e, C, h)
        assert per.count() == groups
        rep = G.replicate_by_color_triple(e, C, h)
        assert rep.count() == C * e.count()
    direct = {tuple(r[:3]): r[3] for r in G.triangles_per_color_triple(e, 4, h).collect()}
    repl = {tuple(r[:3]): r[3] for r in G.triangles_per_color_triple(e, 4, h, "replicate").collect()}
    assert direct == repl


def test_c1_estimates_are_exact(spark):
    e = G.distinct_edges(edge_list(spark, SF001))
    assert one(G.approx_triangles_color(e, 1, Affine(5, 6))) == 7852
    assert one(G.approx_triangles_partition(e, 1, EdgeBucket(5, 6, 7))) == 7852


def test_estimates_are_multiples_of_c2(spark):
    e = G.distinct_edges(edge_list(spark, SF001))
    for C in (2, 3):
        assert one(G.approx_triangles_color(e, C, draw_affine(C, 1)[0])) % (C * C) == 0
        assert one(G.approx_triangles_partition(e, C, draw_edge_bucket(C))) % (C * C) == 0


def test_reversed_copies_and_loops_leave_counts(spark):
    base = G.distinct_edges(edge_list(spark, SF001))
    rev = base.select(base.v.alias("u"), base.u.alias("v"))
    loops = base.select(base.u.alias("u"), base.u.alias("v"))
    more = G.distinct_edges(base.unionByName(rev).unionByName(loops))
    h = Affine(4321, 777)
    for f in (G.triangle_count, lambda d: G.approx_triangles_color(d, 4, h),
              lambda d: G.exact_triangles_color(d, 4, h)):
        assert one(f(base)) == one(f(more))


def test_partition_buckets_follow_formula(spark):
    hb = EdgeBucket(4321, 777, 5)
    e = edges(spark, [(1, 2), (2, 1), (-3, 9000)])
    for r in G.partition_edges(e, 4, hb).collect():
        assert r.part == ((r.u % 8191) * 4321 + (r.v % 8191) * 777 + 5) % 8191 % 4


def test_per_partition_matches_python(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(30), rng.randrange(30)) for _ in range(300)]
    hb = EdgeBucket(17, 23, 4)
    got = {r.part: r.triangles for r in G.triangles_per_partition(edges(spark, pairs), 3, hb).collect()}
    want = {}
    for p in range(3):
        bucket = [(u, v) for u, v in set(pairs) if ((u * 17 + v * 23 + 4) % 8191) % 3 == p]
        want[p] = brute(bucket)
    assert got == want


def test_per_color_matches_python(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(400)]
    h = Affine(101, 7)
    col = lambda x: ((101 * x + 7) % 8191) % 3
    got = {r.color: r.triangles for r in G.triangles_per_color(edges(spark, pairs), 3, h).collect()}
    want = {}
    for c in range(3):
        mono = [(u, v) for u, v in set(pairs) if col(u) == col(v) == c]
        if mono:
            want[c] = brute(mono)
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), max_size=80))
def test_triangle_count_matches_brute_force(spark, pairs):
    assert one(G.triangle_count(edges(spark, pairs))) == brute(pairs)


def test_report_methods(spark):
    raw = edge_list(spark, SF001)
    hs = draw_affine(1, 3)
    exact = G.triangle_report(raw, 4, hs, "exact").collect()[0]
    assert (exact.n_edges, exact.colors, exact.runs, exact.method, exact.triangles) == (1905, 4, 3, "exact", 7852.0)
    part = G.triangle_report(raw, 1, hs, "partition", draw_edge_bucket(1)).collect()[0]
    assert part.triangles == 7852.0


def test_read_edges_text(spark, scratch):
    path = f"{scratch}/g.txt"
    with open(path, "w") as f:
        f.write("1,2\n2,3\n 1,3\n3,1\n")
    e = read_edges(spark, path)
    assert sorted(tuple(r) for r in e.collect()) == [(1, 2), (1, 3), (2, 3), (3, 1)]
    assert one(G.triangle_count(G.distinct_edges(e))) == 1


@pytest.mark.parametrize("line", ["1,x", "1,", ",1", "", '"2","3"', "1,2,3", "7", "1.5,2", "1,2 3"])
def test_read_edges_is_strict(spark, scratch, line):
    path = f"{scratch}/bad.txt"
    with open(path, "w") as f:
        f.write(f"1,2\n{line}\n3,4\n")
    for action in ("collect", "count"):
        with pytest.raises(Exception, match="not an edge"):
            getattr(read_edges(spark, path), action)()


def test_two_estimates_of_the_same_edges(spark):
    raw, hs, hb = edge_list(spark, SF001), draw_affine(1, 3), draw_edge_bucket(2)
    both = G.triangle_report_both(raw, 4, hs, hb).collect()[0]
    assert both.color_triangles == G.triangle_report(raw, 4, hs, "color").collect()[0].triangles
    assert both.partition_triangles == G.triangle_report(raw, 4, hs, "partition", hb).collect()[0].triangles
    assert both.n_edges == 1905


def test_runs_of_one_job_share_their_prime(spark):
    with pytest.raises(ValueError):
        G.approx_triangles_color_median(edges(spark, TRI), 2, [Affine(1, 2), Affine(1, 2, 31)])


@pytest.mark.parametrize("split_above", [1, 2, 5])
def test_heavy_source_split_matches_brute_force(spark, split_above):
    from sparkcount.operators.triangles import count_triangles
    rng = random.Random(split_above)
    # a dense core plus a hub: many sources exceed the tiny split threshold
    pairs = [(a, b) for a in range(12) for b in range(a + 1, 12) if rng.random() < 0.7]
    pairs += [(100, n) for n in range(40)]
    und = G.undirected(edges(spark, pairs))
    assert one(count_triangles(und, split_above=split_above)) == brute(pairs)
    keyed = und.withColumn("g", (und.u % 2).cast("bigint"))
    got = {r.g: r.triangles for r in count_triangles(keyed, ["g"], split_above).collect()}
    want = {}
    for g in (0, 1):
        sub = [(u, v) for u, v in set((min(a, b), max(a, b)) for a, b in pairs if a != b) if u % 2 == g]
        if brute(sub):
            want[g] = brute(sub)
    assert got == want


@pytest.mark.parametrize("salt_above", [1, 3])
def test_salted_targets_match_brute_force(spark, salt_above):
    from sparkcount.operators.triangles import count_triangles
    rng = random.Random(salt_above)
    pairs = [(a, b) for a in range(14) for b in range(a + 1, 14) if rng.random() < 0.6]
    pairs += [(100, n) for n in range(40)] + [(n, n + 1) for n in range(39)]
    und = G.undirected(edges(spark, pairs))
    assert one(count_triangles(und, split_above=4, salt_above=salt_above)) == brute(pairs)


@pytest.mark.parametrize("split_above", [2, 2048])
def test_listed_triangles(spark, split_above):
    from sparkcount.operators.triangles import list_triangles
    rng = random.Random(split_above)
    pairs = [(a, b) for a in range(15) for b in range(a + 1, 15) if rng.random() < 0.5]
    adj = {frozenset(p) for p in pairs}
    got = [frozenset(r) for r in list_triangles(G.undirected(edges(spark, pairs)), split_above=split_above).collect()]
    want = {frozenset(t) for t in itertools.combinations(range(15), 3)
            if all(frozenset(p) in adj for p in itertools.combinations(t, 2))}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("C", [1, 2, 5])
def test_replicated_groups_of_a_dense_graph(spark, C):
    rng = random.Random(C)
    pairs = [(a, b) for a in range(30) for b in range(30) if a != b and rng.random() < 0.25] + [(3, 3)]
    for h in draw_affine(C, 2):
        rows = [G.triangles_per_color_triple(edges(spark, pairs), C, h, m).collect() for m in ("direct", "replicate")]
        assert sorted(rows[0]) == sorted(rows[1])
        assert sum(r.triangles for r in rows[1]) == brute(pairs)


def test_sf0001_with_split(spark):
    from sparkcount.operators.triangles import count_triangles
    und = G.undirected(edge_list(spark, SF001))
    assert one(count_triangles(und, split_above=3)) == 7852


def test_reserved_key_names_are_refused(spark):
    from sparkcount.operators.triangles import count_triangles
    und = G.undirected(edges(spark, TRI)).withColumn("s", F.lit(1))
    with pytest.raises(ValueError):
        count_triangles(und, ["s"])


@pytest.mark.parametrize("salt_above", [1, 3])
def test_salted_groups_match_brute_force(spark, salt_above):
    from sparkcount.functions.hashing import sql_color
    from sparkcount.operators.triangles import count_by_group
    rng = random.Random(salt_above)
    pairs = [(a, b) for a in range(14) for b in range(a + 1, 14) if rng.random() < 0.6]
    pairs += [(100, n) for n in range(40)] + [(n, n + 1) for n in range(39)]
    per = count_by_group(G.undirected(edges(spark, pairs)), 3, sql_color("{n}", 101, 7, 3),
                         "SELECT CAST(sum(n) AS BIGINT) AS triangles FROM per_group", salt_above=salt_above)
    assert one(per) == brute(pairs)


@pytest.mark.parametrize("method", ["direct", "replicate"])
def test_wedges_without_triangles(spark, method):
    # every pair of a left node's neighbours is a wedge; one edge closes eight of them
    pairs = [(a, b) for a in range(8) for b in range(100, 160)] + [(100, 101)]
    per = G.triangles_per_color_triple(edges(spark, pairs), 4, Affine(4321, 777), method).collect()
    assert sum(r.triangles for r in per) == 8 == brute(pairs)
