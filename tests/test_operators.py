import json
import os
import unicodedata

import pytest
from pyspark.sql import functions as F

from plumbline.functions import arrays as fa
from plumbline.functions import text as ft
from plumbline.functions.identity import identity_keys, linked_keys
from plumbline.functions.isbn import canonical_isbn, filename_identity
from plumbline.operators import gates, journal, lineage, resolve, schedule, select, split
from plumbline.operators.components import link_rows
from plumbline.sources import files as src
from plumbline.streaming.journal import current, follow


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def test_isbn(spark):
    values = ["0306406152", "080442957X", "0-306-40615-2", " 080442957x", "9780306406157", "9780306406158", "0306406153", "9770306406157", "", None, "٠٣٠٦٤٠٦١٥٢"]
    assert column(spark, values, canonical_isbn) == ["9780306406157", "9780804429573", "9780306406157", "9780804429573", "9780306406157", None, None, None, None, None, None]
    got = column(spark, ["01_02T_03S_080442957x_7", "1_02T_03S_080442957X_7", "01_02T_03S_0804429570_7", "01_02T_03S_080442957X_7\n"], filename_identity)
    assert got[0].isbn == "080442957X" and got[0].canonical_isbn == "9780804429573" and got[1:] == [None, None, None]


def test_white_space_and_normal_form(spark):
    spaces = [c for c in map(chr, [*range(0x3100)]) if c.isspace()]
    assert len(spaces) == 29
    assert column(spark, [f"a{c}{c}b{c}" for c in spaces], ft.squeezed) == ["a b"] * 29
    values = ["ﬁ  x", "Ａ\u3000b", None, "", "e\u0301"]
    assert column(spark, values, ft.normalized) == [" ".join(unicodedata.normalize("NFKC", v or "").split()) for v in values]


def test_captions(spark):
    values = ["fine", "", None, "1234", "a 한", "Note: x", '{"a"', "ªb", "a <think>"]
    assert column(spark, values, ft.english_issues)[1:4] == [["caption_not_nonempty_string"]] * 2 + [["caption_has_no_latin_letters"]]
    assert column(spark, values, ft.english_issues)[4:7] == [["caption_contains_non_latin_script"], ["caption_contains_translation_metadata"], ["caption_contains_nested_structure"]]
    assert column(spark, values, ft.cache_screen) == [True, False, False, False, False, True, True, True, True]
    assert column(spark, values, ft.prompt_screen) == [True, False, False, False, False, True, True, True, False]
    assert column(spark, ["one", "../escape", "-a", "a" * 151, "a" * 152, "a\n", None], ft.safe_id) == [True, False, False, True, False, False, False]


def test_paths(spark):
    assert column(spark, ["C:\\a b\\x.y.jpg", "/a/x.jpg", "x", ".hidden", "a\\b/c.d"], ft.source_stem) == ["x.y", "x", "x", ".hidden", "c"]
    inside = column(spark, ["/r", "/r/a", "/ra"], lambda c: ft.contained(c, F.lit("/r/")) | ft.contained(c, F.lit("/r")))
    assert inside == [True, True, False]
    assert column(spark, ["/a", "b"], lambda c: ft.rooted(c, F.lit("/r/"))) == ["/a", "/r/b"]
    assert column(spark, ["<a href=\"x\">&'"], ft.html_escape) == ["&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"]


def test_identity_keys(spark):
    rows = spark.createDataFrame([("0-306x", "The  Ｃat!", None, "once\u3000upon", "g", False), (None, "", "", "hidden", None, True)], "isbn string, title string, context string, source_text string, g string, has boolean")
    keys = rows.select(identity_keys(F.col("isbn"), F.col("title"), F.col("context"), F.col("source_text"), F.col("g"), F.col("has")).alias("k")).collect()
    assert keys[0].k[:2] == ["isbn:0306X", "title:thecat"] and keys[0].k[2].startswith("context:") and keys[0].k[3] == "existing-group:g"
    assert keys[1].k == []
    both = rows.limit(1).select(linked_keys(F.array(F.lit("isbn:9780306406157")), F.lit("0306406152"))).first()[0]
    assert both == ["isbn:9780306406157"]


def test_links_are_transitive(spark):
    chain = [(i, f"k{j}") for i in range(60) for j in (i, i + 1)] + [(100, "x"), (101, "x"), (102, None)]
    got = {r.vertex: r.root for r in link_rows(spark.createDataFrame(chain, "vertex long, key string")).collect()}
    assert got == dict.fromkeys(range(60), 0) | {100: 100, 101: 100, 102: 102}
    assert link_rows(spark.createDataFrame([], "vertex long, key string")).count() == 0


def test_draw_is_exact(spark):
    import hashlib

    groups = [f"g{i}" for i in range(500)]
    assert column(spark, groups, lambda g: split.draw(7, g)) == [int(hashlib.sha256(f"7:{g}".encode()).hexdigest()[:16], 16) / 2**64 for g in groups]
    with pytest.raises(ValueError):
        split.split_of(1, F.lit("x"), 0.6, 0.5)


def test_gates(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    reason = gates.first_reason([("one", F.col("x") == 1), ("small", F.col("x") < 3)])
    assert [r[0] for r in rows.select(reason).collect()] == ["one", "small", None]
    with pytest.raises(gates.GateError) as e:
        gates.gate("stage", rows.select(reason.alias("reason")))
    assert e.value.counts == {"one": 1, "small": 1}
    assert gates.assert_retained(rows.where("x > 0"), "x", 2) == 2
    with pytest.raises(ValueError):
        gates.assert_retained(rows.union(rows), "x")


def test_references(spark):
    entries = [(1, "a.jpg", None), (2, "other\\b.jpg", None), (3, "b.jpg", None), (4, "B.JPG", "other"), (5, "", None), (6, "A", None), (7, "x/b.jpg", "other")]
    rows = spark.createDataFrame(entries, "entry int, filename string, source_path string")
    listing = spark.createDataFrame([("/r/x/a.jpg",), ("/r/other/b.jpg",), ("/r/x/b.jpg",)], "path string")
    got = {r.entry: (r.path, r.resolution) for r in resolve.resolve_references(rows, listing, "/r").collect()}
    assert got == {
        1: ("/r/x/a.jpg", "unique_exact_basename"), 2: ("/r/other/b.jpg", "referenced_path"), 3: (None, "ambiguous_exact_basename"), 4: (None, "ambiguous_exact_basename"),
        5: (None, "missing_image_reference"), 6: (None, "image_not_found"), 7: (None, "ambiguous_referenced_paths"),
    }


def test_diverse_selection_ignores_input_order(spark):
    rows = [(f"id{i}", f"g{i % 4}") for i in range(8)]
    got = [[r.id for r in select.diverse(spark.createDataFrame(x, "id string, g string"), "id", "g", 4).collect()] for x in (rows, rows[::-1])]
    assert sorted(got[0]) == sorted(got[1]) and len({i[2:] and int(i[2:]) % 4 for i in got[0]}) == 4


def test_arrays(spark):
    one = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0], [1, 0, 1, 0, 0])], "e array<double>, m array<int>")
    r = one.select(fa.trim_to_mask(F.col("e"), F.col("m")), fa.trim_to_mask(F.col("m"), F.col("m")), fa.guidance(F.slice("e", 1, 3), F.slice("m", 1, 3), F.slice("e", 1, 1), F.slice("m", 1, 1), F.lit(0.0))).first()
    assert r[0] == [1, 2, 3] and r[1] == [1, 0, 1] and r[2].negative == [1, 0, 0] and r[2].negative_mask == [1, 0, 0]
    nan, inf = float("nan"), float("inf")
    cases = [([[1.0]], [1], True), ([[nan]], [1], False), ([[inf]], [1], False), ([[1.0]], [2], False), ([[1.0]], [0], False), ([], [], False), ([[1.0], [2.0]], [1], False), (None, None, False)]
    rows = spark.createDataFrame(cases, "e array<array<double>>, m array<int>, ok boolean")
    assert all(r[0] == r[1] for r in rows.select(fa.valid_text_features(F.col("e"), F.col("m")), "ok").collect())
    with pytest.raises(ValueError):
        fa.scaled(F.col("e"), 1.0, 0.5)


def test_schedule(spark):
    lr = [r.lr for r in schedule.learning_rates(spark, 20, 5, 1.0).orderBy("step").collect()]
    assert lr == pytest.approx([min(1, s / 5) * min(1, max(0.1, (20 - s + 1) / 15)) for s in range(1, 21)])
    plan = schedule.batch_plan(spark.createDataFrame([(i,) for i in range(10)], "id long"), "id", 4, 1, 2).orderBy("position").collect()
    assert [r.step for r in plan] == [7] * 4 + [8] * 4 + [9] * 2 and plan[-1].loss_weight == 0.5


def test_journal(spark):
    schema = "id string, v int"
    lines = lambda *x: spark.createDataFrame(list(enumerate(x, 1)), "ordinal long, line string")
    rows, torn = journal.parse_lines(lines('{"id":"a","v":1}', '{"id":"b","v":2}', "", '{"id":"a","v":3}', '{"id":"c'), schema)
    assert torn
    got = {r.id: (r.v, r.first_seen) for r in journal.compact(rows, "id", "ordinal").collect()}
    assert got == {"a": (3, 1), "b": (2, 2)}
    with pytest.raises(ValueError):
        journal.parse_lines(lines('{"id":"a","v":1}', "{", '{"id":"b","v":1}'), schema)


def test_journal_as_a_stream(spark, tmp_path):
    d = f"{tmp_path}/in"
    os.makedirs(d)
    for k, rows in enumerate([[("a", 1, 1), ("b", 1, 2)], [("a", 2, 3), ("c", 1, 4)]]):
        with open(f"{d}/{k}.json", "w") as f:
            f.writelines(json.dumps({"id": i, "v": v, "o": o}) + "\n" for i, v, o in rows)
        follow(spark, d, "id string, v int, o long", f"{tmp_path}/state", f"{tmp_path}/checkpoint", "id", "o").awaitTermination()
    got = {r.id: (r.v, r.o, r.first_seen) for r in current(spark, f"{tmp_path}/state", 1).collect()}
    assert got == {"a": (2, 3, 1), "b": (1, 2, 2), "c": (1, 4, 4)}


def test_journal_bases_and_restarts(spark, tmp_path):
    d, state = f"{tmp_path}/in", f"{tmp_path}/state"
    os.makedirs(d)
    want, at = {}, 0
    for k in range(7):
        with open(f"{d}/{k}.json", "w") as f:
            for _ in range(5):
                key, at = f"k{at * 7 % 11}", at + 1
                f.write(json.dumps({"id": key, "v": at * 10, "o": at}) + "\n")
                want[key] = (at * 10, at, want[key][2] if key in want else at)
        follow(spark, d, "id string, v int, o long", state, f"{tmp_path}/checkpoint", "id", "o", base_every=3).awaitTermination()
        assert {r.id: (r.v, r.o, r.first_seen) for r in current(spark, state, k).collect()} == want
    assert sorted(x for x in os.listdir(state) if x.startswith("base=")) == ["base=2", "base=5"]
    assert spark.read.parquet(f"{state}/batch=6").count() == 5  # a batch writes what it brings
    # the whole journal at once, elsewhere
    follow(spark, d, "id string, v int, o long", f"{state}2", f"{tmp_path}/checkpoint2", "id", "o").awaitTermination()
    assert sorted(map(tuple, current(spark, f"{state}2", 0).collect())) == sorted(map(tuple, current(spark, state, 6).collect()))


def test_sinks_and_scans(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    for d, text in ((a, "x"), (b, "x")):
        src.write_atomic(f"{d}/f", text)
    assert src.publish_once(a, f"{tmp_path}/t") and not src.publish_once(b, f"{tmp_path}/t")
    src.write_atomic(f"{a}/f", "y")
    with pytest.raises(FileExistsError):
        src.publish_once(a, f"{tmp_path}/t")
    assert src.conflicting_report({"a": 1, "b": 2}, {"a": 1, "b": 3}, ["a", "b"]) == ["b"]
    with open(f"{tmp_path}/p.jsonl", "wb") as f:
        f.write(b'\xef\xbb\xbf{"id": "x", "imageCaption": "a"}\r\n\n{"id": "y", "imageCaption": "b"}\n')
    assert [tuple(r) for r in src.read_prompts(spark, jsonl=f"{tmp_path}/p.jsonl").collect()] == [("x", "a"), ("y", "b")]
    with pytest.raises(ValueError):
        src.read_prompts(spark)
    with open(f"{tmp_path}/c.json", "w") as f:
        json.dump({"imageCaption": "z"}, f)
    assert [tuple(r) for r in src.read_prompts(spark, caption_json=f"{tmp_path}/c.json").collect()] == [("c", "z")]
    os.makedirs(f"{tmp_path}/cache")
    with open(f"{tmp_path}/cache/manifest.json", "w") as f:
        json.dump({"fingerprint": "f", "records": [{"id": "1"}]}, f)
    with open(f"{tmp_path}/latest.json", "w") as f:
        json.dump({"cache_path": "cache"}, f)
    assert src.resolve_cache(spark, f"{tmp_path}/latest.json").first().fingerprint == "f"
    assert lineage.config_digest({"b": 1, "a": "é"}) == lineage.config_digest({"a": "é", "b": 1})


def test_case_folding_of_every_code_point(spark):
    from plumbline.functions.text import casefolded

    known = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    text = [chr(c) for c in known if chr(c) != chr(c).casefold() or chr(c) != chr(c).upper() or c % 50 == 0]
    text += ["ΟΔΟΣ οδος", "STRASSE straße", "ﬁx İı Iı", "Ꭰꭰ Ꮿᏼ"]
    got = spark.createDataFrame([(t,) for t in text], "t string").select("t", casefolded(F.col("t")).alias("f")).collect()
    wrong = [(r.t, r.f) for r in got if r.f != r.t.casefold()]
    assert len(text) > 5000 and wrong == [], wrong[:20]


def test_epochs_are_permutations(spark):
    from plumbline.operators.select import epoch_place

    for n in (1, 2, 3, 7, 10, 99, 1000, 4097):
        rows = spark.range(n).select("id", epoch_place(F.col("id"), n, 1, 0).alias("a"), epoch_place(F.col("id"), n, 1, 1).alias("b"), epoch_place(F.col("id"), n, 2, 0).alias("c")).collect()
        for k in "abc":
            assert sorted(r[k] for r in rows) == list(range(n)), (n, k)
        if n > 90:
            assert len({tuple(r[k] for r in rows) for k in "abc"}) == 3 and sum(r.a == r.id for r in rows) < 0.1 * n
            assert abs(sum((r.id - n / 2) * (r.a - n / 2) for r in rows)) < 0.1 * n**3

