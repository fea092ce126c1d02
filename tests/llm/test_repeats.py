import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from ratemill.llm import queries, repeats

from .conftest import sorted_rows, texts


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    for doc_id, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        kept = bytes(b for b, x in zip(t, gone) if not x)
        yield doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()


def found(docs, **options):
    rows = repeats.remove_repeats(docs, **options)
    assert rows.where("n_bytes - n_removed != octet_length(kept)").isEmpty()
    return [tuple(r) for r in rows.drop("kept").collect()]


def test_sample(sample):
    assert sorted_rows(found(sample)) == sorted_rows(brute(texts(sample), 400))


def test_odd(odd):
    assert sorted_rows(found(odd)) == sorted_rows(brute(texts(odd), 400))


def test_nothing(no_docs):
    assert found(no_docs) == []


@pytest.mark.parametrize("seed,length,every", [(1, 64, 8), (2, 100, 96), (3, 400, 40), (4, 80, 1000)])
def test_edits_shifts_and_periods(spark, seed, length, every):
    """Shared passages cut at any place, edited copies, periodic and few-letter texts."""
    rnd = random.Random(seed)
    alphabets = ["ab", "abcdefghij ", "xyé "]
    passages = ["".join(rnd.choices(rnd.choice(alphabets), k=length * 3)) for _ in range(6)]
    rows = []
    for i in range(60):
        kind, text = i % 4, ""
        for _ in range(rnd.randint(1, 4)):
            p = rnd.choice(passages)
            a, b = sorted(rnd.sample(range(len(p)), 2))
            text += p[a:b] + "".join(rnd.choices("qrstuvw ", k=rnd.randint(0, length)))
        if kind == 1:
            at = rnd.randrange(len(text) or 1)
            text = rows[-1][1][: at + 50] + "!" + rows[-1][1][at + 50 :]
        elif kind == 2:
            text = (rnd.choice(passages)[: rnd.randint(1, length)] * 9)[: length * 4]
        elif kind == 3 and i % 8 == 3:
            text = rnd.choice("az") * rnd.randint(length - 2, 3 * length)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted_rows(found(docs, length=length, every=every)) == sorted_rows(brute(rows, length))


def test_long_texts_in_pieces(spark, monkeypatch):
    """A text of many pieces gives what it gives whole."""
    rnd = random.Random(5)
    passage = "".join(rnd.choices("abcdefgh", k=700))
    filler = lambda n: "".join(rnd.choices("stuvwxyz", k=n))
    text = filler(2_200_000) + passage + filler(900_000) + passage + "z" * 3000
    docs = spark.createDataFrame([(1, text), (2, passage[:399]), (3, passage[5:450])], "doc_id long, text string")
    rows = {r[0]: r for r in found(docs)}
    assert rows[1][2:4] == (700 + 3000, 2) or rows[1][2] >= 3700
    assert rows[2][2] == 0 and rows[3][2] == 445


def test_equal_runs_of_a_tasks_texts_go_on_as_one():
    """A long run of one character, a period and a common passage leave few rows of any class to be shuffled."""
    rnd = random.Random(9)
    passage = "".join(rnd.choices("abcdefgh", k=900))
    ends = ["".join(rnd.choices("stuvwxyz", k=300)) for _ in range(300)]
    rows = ["z" * 9000, "z" * 5000 + ends[0], "xy" * 3000, *(passage + e for e in ends)]
    batch = pa.record_batch([pa.array(range(len(rows))), pa.array(rows)], ["row", "text"])
    first = [r for b in repeats._first_round(iter([batch]), 400, 96) for r in b.to_pylist()]
    # Where the passage ends, runs have one core and different spans; none of them is settled yet.
    most, second = (n for _, n in Counter(r["core"] for r in first if r["n"]).most_common(2))
    assert most <= len(ends) and second < 30
    assert sum(r["n"] > 0 and r["row"] in (0, 2) for r in first) < 10
    listed = [(i, t.encode(), [r["place"] for r in first if r["n"] and r["row"] == i]) for i, t in enumerate(rows)]
    for width in (None, 16, 1):
        runs = [r for b in repeats._hashed_runs(iter(listed), width, 400) for r in b.to_pylist()]
        assert max(Counter((r["core"], r["span"], r["span2"]) for r in runs if r["n"]).values()) == 1
        assert len({(r["row"], r["place"]) for r in runs if r["n"]}) == sum(r["n"] > 0 for r in runs)
    # What is settled in the first round is right and already covers the long runs.
    gone = dict(enumerate(_removed(first, rows)))
    want = {i: r[2] for i, r in enumerate(brute(list(enumerate(rows)), 400))}
    assert all(gone[i] <= want[i] for i in want)
    assert (gone[0], gone[1]) == (9000, 5000) and gone[2] > 5990


def _removed(first, rows):
    for i, text in enumerate(rows):
        places = [r["place"] for r in first if not r["n"] and r["row"] == i]
        yield len(text) - sum(map(len, repeats.kept_text(text.encode(), places, 400)[0]))


@pytest.mark.parametrize("copies", [1, 40])
def test_long_runs_and_copies_beside_each_other_and_apart(spark, copies):
    """Equal runs within a task's texts and elsewhere, with one, few or many of them."""
    rnd = random.Random(copies)
    passage = "".join(rnd.choices("abcdefgh", k=700))
    rows = [(0, "z" * 3000), (1, "q" + "z" * 399), (2, "z" * 450 + passage), (3, "xy" * 600), (4, "y" + "xy" * 201)]
    for i in range(5, 5 + copies):
        rows += [(i, "".join(rnd.choices("stuv", k=i)) + passage[i:] + "".join(rnd.choices("stuv", k=500)))]
    rows += [(100, passage), (101, passage[1:-1]), (102, passage + "z" * 401), (103, None), (104, "z" * 400)]
    want = sorted_rows(brute(rows, 400))
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert sorted_rows(found(docs)) == want


def test_passages_of_over_50_words_go_from_400_bytes_on(spark, tmp_path):
    """Through the query: what a passage shared by documents has in words does not count, and n_bytes stays whole."""
    rnd = random.Random(7)
    words = lambda n, size: " ".join("".join(rnd.choices("abcdefgh", k=size)) for _ in range(n))
    passages = {399: words(57, 6) + "i", 400: words(57, 6) + "ij", 419: words(60, 6), 359: words(60, 5)}
    assert all(len(p) == size for size, p in passages.items())
    rows, want = [], {}
    for size, passage in [*passages.items(), (0, "")] * 3:
        i = len(rows)
        # Different characters beside the passage, so that no more than it is shared.
        text = f"{words(40, 7)} {i:03}{chr(ord('A') + i)}{passage}{chr(ord('a') + i)}{i:03} {words(40, 7)}"
        rows.append((i, text))
        gone = size if size >= 400 else 0
        want[i] = (len(text), gone, int(gone > 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op7_repeats(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in found} == want
