import zlib

from flowgauge.llm import shards
from flowgauge.llm.tables import table


def expected(rows, n=16):
    rows = sorted(((i if i is not None else -10**18, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1, i)
                   for i, t in rows), key=lambda x: x[:3])
    total, before, slots, out = sum(r[2] for r in rows), 0, {}, []
    for _, crc, size, i in rows:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        out.append((i, size, crc, "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        before += size
    return out


def key(row):
    return tuple(-1 if x is None else x for x in row)


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    got = [tuple(r) for r in shards.shards(docs).collect()]
    assert sorted(got) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()]))
    size = [sum(r[1] for r in got if r[4] == k) for k in range(16)]
    assert max(size) - min(size) <= 2 * max(r[1] for r in got)


def test_messy_rows(messy, no_rows):
    got = [tuple(r) for r in shards.shards(messy, partitions=3).collect()]
    assert sorted(got, key=key) == sorted(expected([(r.doc_id, r.text) for r in messy.collect()]), key=key)
    assert shards.shards(no_rows).count() == 0


def test_number_of_partitions_does_not_matter(messy):
    a, b = (sorted((tuple(r) for r in shards.shards(messy, partitions=n).collect()), key=key) for n in (1, 9))
    assert a == b
