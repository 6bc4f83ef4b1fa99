"""Backfill cursors: as texts, and the same rules as columns."""

import pytest

from evidora.errors import ConfigError
from evidora.operators import windows
from evidora.sources.cursors import next_backfill, read_backfill

PLACES = ["a", "b", "c"]
GOOD = {'{"subreddit":"b","after":"t1"}': (1, "t1"), '{"subreddit":"c","after":null}': (2, None), '{"subreddit":"gone","after":"t1"}': (0, None), None: (0, None)}
BAD = ["{no", "3", '["b"]', '{"subreddit":"b"}', '{"subreddit":"b","after":1}', '{"subreddit":1,"after":null}', '{"after":null}', '{"subreddit":"b","listing":"new","after":null}', '{"subreddit":"b","listing":null,"after":null}', "", "null"]


def test_backfill_cursors():
    for cursor, want in GOOD.items():
        assert read_backfill(cursor, PLACES) == want
    for cursor in BAD:
        with pytest.raises(ConfigError):
            read_backfill(cursor, PLACES)
    assert read_backfill(next_backfill(PLACES, 0, "t"), PLACES) == (0, "t")
    assert read_backfill(next_backfill(PLACES, 0, None), PLACES) == (1, None)
    assert next_backfill(PLACES, 2, None) is None


def test_backfill_positions_follow_the_same_rules(spark):
    cursors = spark.createDataFrame([(c,) for c in [*GOOD, *BAD]], "cursor string")
    places = spark.createDataFrame(list(enumerate(PLACES)), "ordinal long, name string")
    made = {r.cursor: (r.outcome, r.ordinal, r.after) for r in windows.backfill_positions(cursors, "cursor", places).collect()}
    assert {c for c, (outcome, ordinal, _) in made.items() if outcome == "malformed" and ordinal is None} == set(BAD)
    assert {c: m[1:] for c, m in made.items() if m[0] != "malformed"} == GOOD
    assert made[None][0] == "start" and made['{"subreddit":"gone","after":"t1"}'][0] == "restart"
