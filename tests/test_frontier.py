"""Crawl frontier."""

from payloads import staged

from jsonmart.plans import frontier


def listing(spark, resource, *pages):
    return staged(spark, resource, *[{"page": p, "total_pages": t, "results": [{"id": i} for i in ids]} for p, t, ids in pages])


def ids(df):
    return [r[0] for r in df.collect()]


def test_ids_are_distinct_and_sorted(spark):
    df = listing(spark, "movie_popular", (2, 3, [5, None, 1]), (1, 3, [9, 5]))
    assert ids(frontier.listing_ids(df)) == [1, 5, 9]


def test_page_bound(spark):
    df = listing(spark, "movie_popular", (1, 2, [1]), (2, 2, [2]), (3, 2, [3]), (1, None, [10]), (2, None, [11]), (1, 0, [12]))
    assert ids(frontier.listing_ids(df)) == [1, 2, 10, 12]
    assert ids(frontier.listing_ids(df, max_pages=1)) == [1, 10, 12]


def test_both_listings(spark):
    popular = listing(spark, "movie_popular", (1, 1, [3, 1]))
    top = listing(spark, "movie_top_rated", (1, 1, [2, 3]))
    assert ids(frontier.movie_ids(popular, top)) == [1, 2, 3]


def test_people_and_cap(spark):
    df = staged(
        spark,
        "credits",
        {"id": 1, "cast": [{"id": 9}, {"id": 2}, {"name": "no id"}], "crew": [{"id": 2}, {"id": "4"}]},
        {"id": 2, "cast": None, "crew": [{"id": 7}]},
    )
    people = frontier.people_ids(df)
    assert ids(people) == [2, 4, 7, 9]
    assert ids(frontier.cap(people, 2)) == [2, 4]
