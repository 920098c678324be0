from __future__ import annotations

import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, make_docs
from tomeworks.llm import decontaminate as d

ITEM = "A train leaves Boston at 60 km per hour and meets another train from Boston after 3 hours of travel on the line"


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")


def found(spark, docs, texts=(ITEM,)):
    rows = d.contained_items(make_docs(spark, docs), items(spark, texts)).collect()
    return {(r.doc_id, r.item_id): r.reparameterised for r in rows}


def test_exact_and_reparameterised(spark):
    other = ITEM.replace("Boston", "Chicago").replace("60", "75").replace("km", "miles").replace(" 3 ", " four ")
    mixed = ITEM.replace("Boston at", "Chicago at").replace("60", "75")  # the two names now differ
    docs = [
        f"Some words before. {ITEM} and some after.",
        f"Some words before. {other} and some after.",
        f"intro {mixed.upper().lower()} outro",
        f"intro {mixed} outro",
        "a train leaves on time and that is all there is to say about this particular train today",
        None,
        "",
    ]
    got = found(spark, docs)
    assert got[0, 0] is False and got[1, 0] is True
    assert (3, 0) not in got and (4, 0) not in got


def test_punctuation_case_and_line_breaks_do_not_hide_an_item(spark):
    words = ITEM.split()
    docs = ["x y z, " + "\n".join(words), "x | " + " | ".join(words), " ".join(f"{w}***" for w in words), ITEM.replace("60 km", "60km")]
    assert set(found(spark, docs)) == {(i, 0) for i in range(4)}


def test_short_items_parts_and_insertions(spark):
    short = "only five words are here"
    half = " ".join(ITEM.split()[:17])
    quarter = " ".join(ITEM.split()[:10])
    inserted = ITEM.replace("another train", "another red train")
    got = found(spark, [f"and {short} too", half, quarter, inserted, "five words are here"], [ITEM, short, "", None, "..."])
    assert set(got) == {(0, 1), (1, 0), (3, 0)}


def plain_template(text):
    return [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", w).lower() for w in text.split()) if w]


def test_query_finds_every_whole_item(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    rows = d.op6_decontaminate(spark, folder).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    texts = {r.doc_id: " " + " ".join(plain_template(r.text)) + " " for r in docs}
    whole = {(i, b.item_id) for i, t in texts.items() for b in bench if f" {' '.join(plain_template(b.text))} " in t}
    assert whole and whole == got


def test_blocks_give_the_same(spark, monkeypatch):
    docs = make_docs(spark, [f"so {ITEM} so", "nothing of it at all in this text", ITEM.lower()])
    one = {tuple(r) for r in d.contained_items(docs, items(spark, [ITEM, "another item of more than eight words in it"])).collect()}
    monkeypatch.setattr(d, "BLOCK", 5)
    assert one == {tuple(r) for r in d.contained_items(docs, items(spark, [ITEM, "another item of more than eight words in it"])).collect()}


def test_odd_rows(spark):
    rows = ODD + [(None, ITEM, None, None, 1), (9, ITEM, "en", "a", 1), (9, ITEM, "en", "a", 1)]
    docs = make_docs(spark, rows).withColumn("key", F.lit("clash")).withColumn("hash", F.lit("clash"))
    left = d.decontaminate(docs, items(spark, [ITEM]).withColumn("size", F.lit(1)))
    assert left.columns == docs.columns and left.count() == len(ODD)
    assert d.decontaminate(docs, items(spark, [ITEM]).limit(0)).count() == len(rows)
    assert d.decontaminate(docs.limit(0), items(spark, [ITEM])).count() == 0


def test_one_changed_word_does_not_hide_an_item(spark):
    """Of items of 9 to 30 words, whichever word is changed; two distant scraps of three words are no item."""
    words = "how did seven old sailors carry their heavy wooden boats over that steep frozen hill before dawn while nobody else was awake".split()
    words += "in all those quiet villages along our northern coast".split()
    texts = [" ".join(words[:n]) for n in (9, 10, 12, 15, 18, 22, 30)]
    docs = [" ".join(["before", *t.split()[:i], "changed", *t.split()[i + 1 :], "after"]) for t in texts for i in range(len(t.split()))]
    got = found(spark, docs, texts)
    wanted = [k for k, t in enumerate(texts) for _ in t.split()]
    assert all((i, k) in got for i, k in enumerate(wanted))
    scraps = f"{' '.join(words[:3])} {'and then more ' * 20} {' '.join(words[4:7])}"
    assert found(spark, [scraps], texts[:1]) == {}


def test_long_run_of_a_long_item(spark):
    item = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80))
    docs = [" ".join(item.split()[20 : 20 + n]) for n in (12, 13)]
    assert set(found(spark, docs, [item])) == {(1, 0)}


def test_one_number_for_two_things_and_names_at_sentence_starts(spark):
    apples = "someone picked 5 apples in the garden and then gave them all to 5 friends who came along for lunch"
    starts = "Alice has four red marbles. Bob gives her two more. Alice loses one of them. Bob finds it again today."
    docs = [
        f"so {apples.replace('5 apples', '7 apples').replace('5 friends', '3 friends')} then",
        f"Once more. {starts.replace('Alice', 'Carol').replace('Bob', 'Dan')} That is all.",
        f"once more. {ITEM.lower()} that is all.",
        f"once more. {starts.lower()} that is all.",
    ]
    got = found(spark, docs, [apples, starts, ITEM])
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 1)}
    assert got[0, 0] and got[1, 1] and not got[2, 2]


def test_lists_of_numbers_only_match_themselves(spark):
    rng = random.Random(6)
    evens = " ".join(str(n) for n in range(2, 26, 2))
    sizes = "take 3 kg 4 kg 5 kg 6 kg 7 kg 8 kg 9 kg 10 kg"
    other = " ".join(f"{rng.randrange(100)} kg" for _ in range(300))
    docs = [" ".join(str(rng.randrange(1000)) for _ in range(3000)), f"the list {evens} is here", other, f"please {sizes} now"]
    assert found(spark, docs, [evens, sizes]) == {(1, 0): False, (3, 1): False}


def test_a_batch_is_read_together_and_windows_stay_in_their_text(monkeypatch):
    texts = [ITEM, None, "", "* # .", "so Boston", f"Then. {ITEM.upper()} 5kg", "on the line so", f"{ITEM} {ITEM}"] * 3
    words = ITEM.split()
    texts += [" ".join(words[:11]), " ".join(words[11:])]  # neighbours that make the item
    wanted = pa.RecordBatch.from_pydict({"item_id": [1], "text": [ITEM]})
    hashes = next(d._item_windows(iter([wanted]))).column("hash").to_numpy().view("uint64")
    shared = SimpleNamespace(value=np.unique(hashes))
    calls = []
    read = d.readings_of
    monkeypatch.setattr(d, "readings_of", lambda own, kinds: calls.append(len(own)) or read(own, kinds))

    def hits(part):
        keys = pa.array([b"%d" % i for i in range(len(texts))])
        batch = pa.RecordBatch.from_arrays([keys, pa.array(range(len(texts))), pa.array(texts)], ["key", "doc_id", "text"])
        monkeypatch.setattr(d, "PART", part)
        rows = [row for made in d._hits(shared, [d.window_size(len(words))])(iter([batch])) for row in made.to_pylist()]
        return sorted(rows, key=lambda row: (row["doc_id"], row["doc_pos"], row["hash"]))

    together = hits(1 << 18)
    assert calls == [len(texts)]
    assert together and together == hits(1)


def test_groups_of_hits_become_python_objects_one_at_a_time():
    hit = {"reading": 0, "size": 8, "n_words": 400, "item_slots": ["boston"] * 4, "doc_slots": ["chicago"] * 4}
    groups = [[{**hit, "item_pos": i, "doc_pos": i + 3} for i in range(300)] for _ in range(100)]
    numbers = list(range(len(groups)))
    batch = pa.RecordBatch.from_pydict({"key": [b"k"] * len(groups), "doc_id": numbers, "item_id": numbers, "hits": groups})
    d._SEEN.places(["some", "words"])
    tracemalloc.start()
    made = [row for part in d._found(0.5)(iter([batch])) for row in part.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [row["doc_id"] for row in made] == numbers and {row["n_windows"] for row in made} == {300}
    assert peak < 4 << 20  # all of them are over 30 MB
    assert not d._SEEN
