"""The pairing state is kept per bucket of cards, not per card."""

import random

import numpy as np
import pandas as pd
import pytest

from tests.conftest import SF_SMALL
from tests.test_replay import State
from tapflow.plans import stream as plans
from tapflow.operators.dedup import dedup_taps_stream
from tapflow.operators.validate import select_tap_fields
from tapflow.session import scratch_path
from tapflow.streaming.pairing import make_pairing_function, pair_taps_stream
from tapflow.streaming.replay import Replay
from tapflow.streaming.run import start_file_sink

LIMIT = 600_000_000


class Timed(State):
    def setTimeoutTimestamp(self, ms):
        assert ms >= self.watermark                 # Spark's own rule
        self.timeout = ms


def plain(taps, limit):
    """(kind, card, tap_in, tap_out), one tap after the other; what is still
    open at the end has waited too long where there is a limit."""
    out, open_ = [], {}
    for us, tx, card, kind in sorted(taps):
        before = open_.pop(card, None)
        if before and limit is not None and us - before[0] > limit:
            out.append(("expired", card, before[1], None))
            before = None
        if kind == "tap_in":
            open_[card] = (us, tx)
        elif before:
            out.append(("trip", card, before[1], tx))
    return out + [("expired", c, tx, None) for c, (_, tx) in open_.items() if limit is not None]


@pytest.mark.parametrize("limit", [None, LIMIT])
@pytest.mark.parametrize("ordered", [True, False])
def test_a_bucket_of_cards_pairs_card_by_card(limit, ordered):
    """Cards of one bucket do not pair with each other, wait for themselves and
    expire by themselves, in whatever micro-batches they come."""
    for seed in range(5):
        rnd = random.Random(seed)
        now, taps = 1_700_000_000_000_000, []
        for i in range(400):
            now += rnd.choice([0, 1, 10_000_000, 60_000_000, LIMIT // 2])
            taps.append((now, f"t{i:04d}", f"C{rnd.randrange(12)}", rnd.choice(["tap_in", "tap_out"])))
        pair = make_pairing_function(None if limit is None else limit // 1_000_000, ordered)
        state, got, seen, calls = Timed(), [], 0, 0
        while seen < len(taps) or state.watermark <= (now + 3 * LIMIT) // 1000:
            batch = taps[seen:seen + rnd.randrange(1, 60)]
            if seen >= len(taps):
                state.watermark = (now + 4 * LIMIT) // 1000
            seen += len(batch)
            if ordered:
                rnd.shuffle(batch)
            frame = pd.DataFrame({"transaction_id": [t[1] for t in batch], "card_id": [t[2] for t in batch], "bus_id": "BUS-1",
                                  "event_type": [t[3] for t in batch],
                                  "event_time": pd.to_datetime([t[0] for t in batch], unit="us"),
                                  "latitude": 1.0, "longitude": 2.0})
            for out in pair((7,), iter([frame] if batch else []), state):
                got += list(zip(out["record_type"], out["card_id"], out["tap_in_tx_id"], out["tap_out_tx_id"]))
            calls += 1
            if seen < len(taps):
                state.watermark = max(t[0] for t in taps[:seen]) // 1000
        assert calls < 60
        assert sorted(map(str, got)) == sorted(map(str, plain(taps, limit))) and len(got) > 50
        assert state.exists is (limit is None) and (limit is None or state.timeout is not None)


def test_states_do_not_grow_with_the_cards(spark):
    """At most one state and one call per bucket and micro-batch, however many
    cards there are."""
    rows = plans._replay_rows(spark, SF_SMALL)
    cards = rows.select("card_id").distinct().count()
    got = []
    for buckets in (3, 64):
        replay = Replay(rows, 2)
        pairs = pair_taps_stream(select_tap_fields(dedup_taps_stream(replay.stream)), buckets=buckets)
        out = scratch_path(spark, "test-buckets")
        query, = replay.run(lambda: start_file_sink(pairs, out, scratch_path(spark, "test-ckpt"), trigger={"processingTime": "0 seconds"}))
        states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"] == "applyInPandasWithState"]
        assert 0 < max(states) <= buckets and cards > 3
        got.append(sorted(r[0] for r in spark.read.schema(pairs.schema).parquet(out).select("trip_id").collect()))
    assert got[0] == got[1] != []


def test_ids_of_trips_name_their_own_card():
    """Two cards' rows side by side in one call."""
    from tapflow.streaming.pairing import _trip_ids
    one, two = _trip_ids(np.array(["A", "B"], object), np.array(["i", "i"], object), np.array(["o", "o"], object))
    assert one != two
