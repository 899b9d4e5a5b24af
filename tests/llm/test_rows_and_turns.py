"""Line dedup and preference formatting."""

from cairnbook.llm import catalog, line_dedup, preference


def test_sentences_pasted_into_lines(spark):
    passage = "Here is a passage of more than eight words. And there is a second sentence of eight words!"
    rows = [(1, f"A start. {passage} And an end."), (2, f"Other words {passage[:20]}\nIt is said. {passage}  Is it?\nok"), (3, passage), (4, f"one\n{passage.upper()}")]
    got = {r.doc_id: r for r in line_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[1].kept_text == rows[0][1]
    assert got[2].n_removed == 2 and got[2].kept_text == f"Other words {passage[:20]}\nIt is said. Is it?\nok"
    starts = [int(x.split(":")[0]) for x in got[2].removed.split(",")]
    assert [rows[1][1][s:s + 4] for s in starts] == ["Here", "And "]
    assert got[3].n_removed == 2 and got[3].kept_text == ""
    assert got[4].removed == f"4:{4 + len(passage)}" and got[4].kept_text == "one"


def test_a_very_long_text(spark):
    text = "\n".join(f"line {k % 1000} of a text" for k in range(200_000))
    row = line_dedup.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_units, row.n_removed) == (200_000, 199_000) and row.kept_text == text[:len(row.kept_text)]


def test_earliest_line_stays_with_offsets(spark):
    line, other = "one two three four five", "six seven eight nine ten"
    rows = [(5, f"{line}\nx\n{other}"), (2, f"x\n  ONE two\tthree four five \n{other}"), (2, f"x\n  ONE two\tthree four five \n{other}"), (9, f"{line}\n{line}\nshort"), (None, line), (7, None), (8, ""), (11, "é é é é é\né é é é é")]
    got = sorted(((str(r.doc_id), r.n_units, r.n_removed, r.removed, r.kept_text) for r in line_dedup.remove_repeats(spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, unit int")).collect()))
    first = rows[1][1]
    assert got == sorted([("5", 3, 3, "0:23,24:25,26:50", ""), ("2", 3, 0, "", first), ("2", 3, 0, "", first), ("9", 3, 2, "0:23,24:47", "short"),
                          ("None", 1, 1, "0:23", ""), ("7", 1, 0, "", ""), ("8", 1, 0, "", ""), ("11", 2, 1, "10:19", "é é é é é")])
    assert line_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_unequal_texts_under_one_id_all_stay(spark):
    line = "one two three four five"
    rows = [(1, line), (5, f"{line}\nshort"), (5, "other"), (5, None), (None, f"x\n{line}"), (None, "y"), (None, "y"), (None, None)]
    got = sorted((str(r.doc_id), r.n_units, r.n_removed, r.removed, r.kept_text) for r in line_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("1", 1, 0, "", line), ("5", 2, 1, "0:23", "short"), ("5", 1, 0, "", "other"), ("5", 1, 0, "", ""), ("None", 2, 1, "2:25", "x"),
                          ("None", 1, 0, "", "y"), ("None", 1, 0, "", "y"), ("None", 1, 0, "", "")])


def unmask(text, mask):
    out, at = "", 0
    for run in mask.split(",") if mask else []:
        n, bit = run.split(":")
        out += text[at:at + int(n)] if bit == "1" else ""
        at += int(n)
    assert at == len(text)
    return out


def test_prefix_once_and_masks(spark):
    schema = "pair_id long, turn long, role string, text string, p string"
    chosen = [(1, 0, "user", "hé <|end|>"), (1, 1, "assistant", "good"), (2, 0, "user", "a"), (3, 0, "user", "same"), (3, 1, "assistant", "same"), (4, 0, "user", "alone"), (5, 0, None, None), (None, 0, "user", "x"), (6, 1, "assistant", "b"), (6, 1, "assistant", "a")]
    rejected = [(1, 0, "user", "hé <|end|>"), (1, 1, "assistant", "bad"), (1, 2, "user", "why"), (2, 0, "system", "a"), (3, 7, "user", "same"), (3, 9, "assistant", "same"), (5, 0, None, None), (5, 1, "assistant", "")]
    make = lambda rows: spark.createDataFrame([(*r, "") for r in rows], schema)
    got = {r.pair_id: r for r in preference.format_pairs(make(chosen), make(rejected)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert got[1].n_prompt_turns == 1 and got[1].prompt == "<|user|>\nhé < |end|><|end|>\n"
    assert got[1].chosen == "<|assistant|>\ngood<|end|>\n" and unmask(got[1].chosen, got[1].chosen_mask) == "good<|end|>\n"
    assert unmask(got[1].rejected, got[1].rejected_mask) == "bad<|end|>\n" and got[1].rejected.endswith("<|user|>\nwhy<|end|>\n")
    assert got[2].n_prompt_turns == 0 and got[2].prompt == ""
    assert got[3].n_prompt_turns == 2 and got[3].chosen == got[3].rejected == got[3].chosen_mask == ""
    assert got[4].rejected == "" and got[4].prompt == ""
    assert got[5].n_prompt_turns == 1 and got[5].chosen == "" and unmask(got[5].rejected, got[5].rejected_mask) == "<|end|>\n"
    assert got[6].chosen == "<|assistant|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert preference.format_pairs(make([]), make([])).collect() == []
    plan = preference.format_pairs(make(chosen), make(rejected))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_conversation_makes_a_pair(spark, tmp_path):
    said = [(1, 0, "user", "a"), (1, 1, "assistant", "A"), (1, 2, "user", "thanks"), (4, 0, "user", "b"), (7, 0, "user", "c"), (7, 1, "assistant", None),
            (9, 0, "user", "d"), (9, None, "assistant", "D"), (None, 0, "user", "x")]
    spark.createDataFrame(said, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.pair_id: r for r in catalog.QUERIES["op5_preference"](spark, str(tmp_path)).collect()}
    assert set(got) == {1, 4, 7, 9}
    assert got[1].n_prompt_turns == 1 and got[1].chosen == "<|assistant|>\nA<|end|>\n<|user|>\nthanks<|end|>\n" and got[1].rejected == ""
    assert got[4].n_prompt_turns == 1 and got[4].chosen == "" and got[4].rejected == "<|assistant|>\n<|end|>\n"
    assert got[7].chosen == "<|assistant|>\n<|end|>\n" and got[7].rejected == "<|assistant|>\nD<|end|>\n"
    assert got[9].n_prompt_turns == 0 and got[9].rejected == ""
