import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterline.llm import sharding


@pytest.fixture(scope="module")
def rows(docs):
    return sharding.digest(sharding.vector_shards(docs, 8)).collect()


def test_every_row_has_its_shard_and_slot(rows, texts):
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = defaultdict(list)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_loads_are_near_equal_and_groups_whole(rows, texts):
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    biggest = max(len(t.encode()) for t in texts.values())
    assert max(load.values()) - min(load.values()) <= biggest
    shards = defaultdict(set)
    for r in rows:
        shards[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_hot_group_is_dealt_into_pieces(ready):
    rows = ready.range(3000).selectExpr("id as doc_id", "case when id < 1500 then 'same text' else concat('text number ', id) end as text")
    got = sharding.vector_shards(rows, 10).collect()
    load = Counter(r.shard for r in got)
    assert len(got) == 3000 and max(load.values()) <= 1.2 * min(load.values())


def test_repeated_rows_of_one_id_are_dealt(ready):
    """Equal rows of one id are dealt like any others, and no cell holds them all."""
    rows = ready.range(3200).selectExpr("case when id < 3000 then 7 else id end as doc_id", "case when id < 3000 then 'same text again' else concat('text number ', id) end as text")
    got = sharding.vector_shards(rows, 8).collect()
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    assert len(got) == 3200 and max(load.values()) <= 1.05 * min(load.values())
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def test_placement_follows_the_residual_vector():
    items = np.array([[0.5, 0.1], [0.1, 0.5], [0.2, 0.2], [0.2, 0.2]])
    chosen = sharding.place(items, 2)
    assert chosen[0] != chosen[1]
    # what the dot product leaves uneven in bytes is moved at the end
    assert np.allclose([items[chosen == s, 0].sum() for s in (0, 1)], 0.5)


def test_odd_rows(odd, none):
    got = sharding.digest(sharding.vector_shards(odd, 3)).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert (by_id[1].size, by_id[1].text_crc32) == (16, 0) and (by_id[2].size, by_id[2].tokens) == (16, 0)
    assert by_id[4].shard != by_id[6].shard
    assert sharding.vector_shards(none, 3).count() == 0
