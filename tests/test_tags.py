"""Tag cleanup, tokens and pairs on the small inline cases of FIXTURES.md s.5."""

from conftest import rows

from tagloom.operators import tags as t
from tagloom.operators import totals as tot


def _posts(make_posts, *tag_strings):
    return make_posts([(i + 1, s, 1, 1, 1, "2010-05-01") for i, s in enumerate(tag_strings)])


def test_plain_pair(make_posts):
    pt = t.post_tags(_posts(make_posts, "<a><b>"))
    assert rows(pt, "techlist") == [("a b",)]
    assert rows(t.tag_pairs(pt), "tech1", "tech2") == [("a", "b"), ("b", "a")]


def test_single_tag_gives_list_row_only(make_posts):
    pt = t.post_tags(_posts(make_posts, "<a>"))
    assert rows(t.tag_tokens(pt), "tag") == [("a",)]
    assert t.tag_pairs(pt).count() == 0
    assert tot.tech_node(pt).count() == 0          # D4
    assert tot.tag_date(pt).count() == 0
    assert rows(tot.tag_list(pt), "techlist", "weight", "app_num") == [("a", 3, 1)]


def test_repeated_tag(make_posts):
    pt = t.post_tags(_posts(make_posts, "<a><b><a>"))
    assert rows(t.tag_pairs(pt), "tech1", "tech2") == [("a", "b")] * 2 + [("b", "a")] * 2
    rel = rows(tot.tech_rel(pt))
    assert rel == [("a", "b", 6, 2), ("b", "a", 6, 2)]
    # node a counted once for the post
    assert rows(tot.tech_node(pt)) == [("a", 3, 1), ("b", 3, 1)]
    # appNum counts pair rows: a is in 2 rows, b in 2 rows
    assert rows(tot.tag_date(pt), "tech", "app_num") == [("a", 2), ("b", 2)]
    assert rows(tot.tag_date(pt, count="posts"), "tech", "app_num") == [("a", 1), ("b", 1)]


def test_empty_string_gives_no_token(make_posts):
    pt = t.post_tags(_posts(make_posts, ""))
    assert t.tag_tokens(pt).count() == 0            # D15
    assert t.tag_pairs(pt).count() == 0


def test_null_tags_filtered(make_posts):
    posts = make_posts([(1, None, 1, 1, 1, "2010-01-01"), (2, "<x><y>", 1, 1, 1, "2010-01-01")])
    assert rows(t.post_tags(posts), "id") == [(2,)]


def test_pipe_kept_whole(make_posts):
    pt = t.post_tags(_posts(make_posts, "<a|b><c>"))
    assert rows(tot.tech_rel(pt), "technode1", "technode2") == [("a|b", "c"), ("c", "a|b")]


def test_null_count_is_zero(make_posts):
    posts = make_posts([(1, "<a><b>", 1, 2, None, "2010-01-01")])
    assert rows(t.post_tags(posts), "weight") == [(3,)]     # D2


def test_non_ascii_list(make_posts):
    pt = t.post_tags(_posts(make_posts, "<café><c++>"))
    assert rows(tot.clean_tag_lists(pt), "techlist") == [("caf c++",)]
    assert rows(tot.tag_list(pt), "techlist") == [("caf c++",)]


def test_long_list_is_kept_whole(make_posts):
    tags = "".join(f"<t{i:05d}>" for i in range(200))    # 1,399 characters as a list
    pt = t.post_tags(_posts(make_posts, tags))
    (text,), = rows(tot.clean_tag_lists(pt), "techlist")
    assert text == " ".join(f"t{i:05d}" for i in range(200))


def test_empty_list_has_no_tag(make_posts):
    assert rows(t.tag_lists(t.post_tags(_posts(make_posts, "", "<a><b>"))), "n_tags") == [(0,), (2,)]


def test_many_repeats_do_not_overflow(make_posts):
    """Two tags of 50,000 repeats each stand for 2.5e9 ordered pair rows each way."""
    pt = t.post_tags(_posts(make_posts, "<a>" * 50_000 + "<b>" * 50_000))
    assert rows(tot.tag_date(pt), "tech", "app_num") == [("a", 2_500_000_000), ("b", 2_500_000_000)]
    assert rows(tot.tech_rel(pt), "technode1", "cnt") == [("a", 2_500_000_000), ("b", 2_500_000_000)]


def test_day_from_timestamp(make_posts):
    posts = make_posts([(1, "<a><b>", 0, 0, 0, "2012-03-04T23:59:59")])
    import datetime as dt
    assert rows(t.post_tags(posts), "day") == [(dt.date(2012, 3, 4),)]


def test_units_of_a_big_post(make_posts):
    """A post dealt out as many units gives what one unit gives."""
    many = "".join(f"<t{i}>" for i in range(12)) + "<t1><t2>"
    posts = _posts(make_posts, many, "<a><b><a>", "<x><y><z>")
    pt = t.post_tags(posts)
    assert rows(t.tag_pairs(pt)) == rows(t.tag_pairs(pt, unit_tokens=4))
    assert rows(tot.tech_rel(pt)) == rows(tot.tech_rel(pt, unit_tokens=4))


def test_long_repeated_tags(make_posts):
    """Two tags of 50,000 repeats each: products beyond 32 bits."""
    pt = t.post_tags(_posts(make_posts, "<a><b>" * 50_000))
    assert [r[3] for r in rows(tot.tech_rel(pt))] == [2_500_000_000] * 2
    assert [r[3] for r in rows(tot.tag_date(pt))] == [2_500_000_000] * 2


def test_units_of_a_huge_post_are_spread(spark, make_posts):
    """A post of 2,000 distinct tags: its pairs come from several tasks."""
    from pyspark.sql import functions as F
    pt = t.post_tags(_posts(make_posts, "".join(f"<t{i}>" for i in range(2_000))))
    half = t.half_pair_counts(pt, unit_tokens=100)
    per_task = half.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in per_task) == 2_000 * 1_999 // 2
    assert len(per_task) > 1


def test_record_without_day(spark):
    """P5: a post without a creation date counts in the pair and tag totals
    but gives no date row."""
    from tagloom.sources.fixtures import SCHEMAS
    posts = spark.createDataFrame([(1, "<a><b>", 1, 0, 0, None)], SCHEMAS["posts"])
    pt = t.post_tags(posts)
    assert rows(tot.tech_rel(pt)) == [("a", "b", 1, 1), ("b", "a", 1, 1)]
    assert tot.tag_date(pt).count() == 0


def test_cleanup_matches_string_steps_on_random_text(spark):
    """F1-F3 on 600 random tag strings (brackets, blanks, letters, a non-ASCII
    letter) against the plain string steps: '<' and '>' to a blank, one pass
    of double blank to blank, strip, split at a blank, empty tokens dropped."""
    import random

    from tagloom.functions.tags import clean_tag_text, split_tags
    rnd = random.Random(7)
    alphabet = ["<", ">", " ", "a", "b", "c", "é", "-", "+"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30)))
             for _ in range(600)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, tags string")
    got = {r["i"]: (r["techlist"], list(r["tokens"])) for r in df.select(
        "i", clean_tag_text("tags").alias("techlist"),
        split_tags(clean_tag_text("tags")).alias("tokens")).collect()}
    for i, s in enumerate(texts):
        text = s.replace("<", " ").replace(">", " ").replace("  ", " ").strip()
        want = [x for x in text.split(" ") if x != ""]
        assert got[i] == (text, want), s
    # (the trim removes blanks; tag strings hold no tabs or line breaks)


def test_lists_equal_after_cleanup_group_together(make_posts):
    """The list text is cleaned before grouping, so lists that differ only
    in non-ASCII letters are one row; long lists that differ late are two."""
    long_a = "".join(f"<t{i:05d}>" for i in range(200)) + "<xa>"
    long_b = "".join(f"<t{i:05d}>" for i in range(200)) + "<xb>"
    posts = make_posts([(1, "<café><b>", 1, 0, 0, "2011-02-03"),
                        (2, "<caf><b>", 2, 0, 0, "2011-02-03"),
                        (3, long_a, 1, 0, 0, "2011-02-03"),
                        (4, long_b, 1, 0, 0, "2011-02-03")])
    got = rows(tot.tag_list(t.post_tags(posts)), "techlist", "weight", "app_num")
    assert got[0] == ("caf b", 3, 2)
    assert len(got) == 3 and got[1][0].endswith(" xa") and got[2][0].endswith(" xb")
