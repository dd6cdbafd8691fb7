import random
import re
import time

import pytest
"""Texts to records: places, windows, dedup, composition."""

from pyspark.sql import functions as F

from augury.functions.sentences import FirstPlaces, located, pieces_of
from augury.operators import guidance as ops
from augury.operators.filings import filter_min_length

PAD = "Our sites run well and our crews like the work they do there each day of the week. " * 5


def records(df):
    rows = ops.extract_guidance(df).orderBy("accession_number", "sent_ord", "metric_ord").collect()
    return [r.asDict() for r in rows]


def brief(df):
    return [(r["metric"], r["val1"], r["val2"], r["pdicity"], r["fiscal_year"], r["action"]) for r in records(df)]


def test_sentences_are_cut_like_the_definition(spark):
    text = 'One. Two! Three?\n\nFour 1.5 "five." six. '
    row = [[piece for _, piece in pieces_of(text)]]
    assert row[0] == ["One.", "Two!", "Three?", 'Four 1.5 "five." six.', ""]


def test_one_record(texts):
    text = PAD + "For Q2 2026 we expect revenue of $10 to $12 million."
    (r,) = records(texts(text))
    assert (r["metric"], r["val1"], r["val2"], r["is_range"]) == ("Revenue", 10e6, 12e6, True)
    assert (r["midpoint"], r["range_width"]) == (11e6, 2e6)
    assert (r["pdicity"], r["fiscal_year"], r["action"]) == ("Q2", 2026, "issues")
    assert r["sentence"] == "For Q2 2026 we expect revenue of $10 to $12 million."


def test_short_and_missing_texts_give_nothing(texts):
    sentence = "We expect revenue of $5 million. "
    assert records(texts(sentence.ljust(99, "x"), None, "")) == []
    assert len(records(texts(sentence.ljust(100, "x")))) == 1


def test_neutral_text_in_front_changes_no_value(texts):
    sentence = "We expect EBITDA of $3 billion to $4 billion and capex near $2 million this year."
    plain = brief(texts(sentence + " " + PAD))
    moved = brief(texts("\U0001f600 " + PAD + sentence + " " + PAD))
    assert [r[:3] for r in plain] == [r[:3] for r in moved] == [
        ("EBITDA", 3e9, 4e9), ("Capex", 3e9, 4e9),
    ]


def test_value_window_opens_fifty_characters_early(texts):
    text = PAD + "Debt is $9 to $11 million. We expect gross margin of 46 percent. " + PAD
    assert brief(texts(text))[0][:3] == ("Gross_Margin", 9e6, 11e6)


def test_repeated_sentences_share_the_first_place(texts):
    sentence = "We expect sales of $8 million."
    text = f"In the first quarter, {sentence} " + PAD + f"In Q3: {sentence} " + PAD + sentence + " " + PAD
    found = records(texts(text))
    # The bare third copy is found inside the first sentence, so it is the same value.
    assert [(r["val1"], r["pdicity"], r["sent_ord"]) for r in found] == [(8e6, "Q1", 0)]


def test_bare_sentence_takes_the_context_of_its_first_occurrence(texts):
    sentence = "We expect capex of $6 million."
    text = f"First quarter: {sentence[:-1]}, too. " + PAD + "We expect capex of $6 million. Q3 " + PAD
    spread_out = records(texts(text.replace("$6 million, too", "$7 million, too")))
    assert [(r["val1"], r["pdicity"]) for r in spread_out] == [(7e6, "Q1"), (6e6, "Q3")]


def test_zero_value_and_truncated_sentence(texts):
    text = "We expect revenue of $0 " + "and more words " * 60 + "now. " + PAD
    (r,) = records(texts(text))
    assert (r["val1"], r["midpoint"], r["range_width"]) == (0.0, 0.0, 0.0)
    assert len(r["sentence"]) == 500


def test_row_chain_and_document_form_agree(spark, texts):
    bodies = [
        PAD + "We expect revenue of $10 to $12 million. We guide EPS to $1.10 in Q1! Sales rose $4 million.",
        "\U0001f600 Management raises its outlook for net income per share to $2.50 - $2.75 for FY25. " + PAD,
        PAD + "We see tax rate near $5 more. " * 3 + "We see tax rate near $5 more in H2 2027. ",
        PAD + "Nothing here costs money.",
    ]
    df = texts(*bodies)
    rows = ops.split_sentences(filter_min_length(df.select("accession_number", "text")))
    valued = ops.extract_values(ops.detect_metrics(ops.filter_guidance_sentences(rows)))
    labelled = ops.detect_action(ops.detect_fiscal_year(ops.detect_period(valued)))
    chain = ops.truncate_sentence(ops.dedup_in_document(labelled))
    columns = ["accession_number", "metric", "val1", "val2", "is_range", "pdicity", "fiscal_year",
               "action", "sentence", "sent_ord"]
    one = sorted(map(str, chain.select(columns).collect()))
    other = sorted(map(str, ops.extract_guidance(df).select(columns).collect()))
    assert one == other and len(one) > 4


def test_order_of_input_does_not_matter(texts):
    bodies = [PAD + f"We expect sales of ${i} million to ${i + 1} million. We see EPS of $1.{i:02d}." for i in range(1, 30)]
    df = texts(*bodies)
    assert brief(df) == brief(df.repartition(3).orderBy(F.desc("accession_number")))


def test_long_text_with_many_copies(texts):
    many = "We expect revenue of $10 to $12 million. Something else stands here. " * 2000
    assert len(records(texts(many))) == 1


def test_places_of_odd_sentences(spark):
    text = r"We see \E and \Q twice (a+b). " + "\U0001f600 x. (a+b). \\E and. $1\\2. x. " + "é. "
    plain = text.replace("\U0001f600", "o")
    for body in (text, plain, plain + "Filler words stand here. " * 300 + "(a+b). " + "z" * 1500):
        df = spark.createDataFrame([("k", body)], "accession_number string, text string")
        for row in ops.split_sentences(df).collect():
            assert row["sent_start"] == body.find(row["sentence"]), row["sentence"]
            assert row["context"] == body[row["context_start"]:][: len(row["context"])]


@pytest.mark.parametrize("end", ["", "\U0001f600"])
def test_places_take_linear_time(end):
    def seconds(repeats):
        body = "".join(
            f"We expect capex of $1.{i % 97} million in Q{i % 4}. Costs of item {i} fell. " for i in range(repeats)
        ) + end
        start = time.process_time()
        assert sum(1 for _ in located(body, priced=True)) > repeats
        return time.process_time() - start

    seconds(1000)
    small = min(seconds(6_000) for _ in range(3))
    assert seconds(60_000) < 25 * max(small, 0.02)


def test_first_places_equal_plain_search():
    r = random.Random(4)
    for _ in range(3000):
        body = "".join(r.choice(["a", "b", ". ", "! ", ".", "$1.5", " "]) for _ in range(r.randint(0, 30)))
        places, pieces = FirstPlaces(body), pieces_of(body)
        for i, (own, piece) in enumerate(pieces):
            assert places.find(own, piece, i == len(pieces) - 1) == body.find(piece), (body, piece)


def test_located_batches_leave_in_bounded_parts():
    import pyarrow as pa

    from augury.functions.sentences import locate_batches

    texts = ["We expect revenue of $5 million. " * 600, None, "", "Up. Down."] * 300
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    parts = list(locate_batches("text", False)(iter([batch, batch.slice(0, 0)])))
    assert max(p.num_rows for p in parts) <= 300 and len(parts) > 5
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(len(texts)))
    sizes = [len(x) if x is not None else 0 for p in parts for x in p.column("located").to_pylist()]
    assert sizes == [601, 0, 1, 2] * 300


def test_opening_letters_never_hide_a_match(spark):
    from itertools import product

    from augury.functions import fixed_values as fixed
    from augury.functions.text import may_match

    def spelled(alternative):
        """Texts of an alternative: each optional part there or not, each choice of a group."""
        short = alternative.replace(r"\s+", " ").replace(r"\s*", "").replace("[0-9]{2}", "25").replace(r"(?:\s|-)", "-")
        parts = re.findall(r"\(\?:([^()]*)\)(\??)|(\w)(\??)|(\[\w+\])(\??)|([^\w])", short)
        choices = []
        for group, g_opt, letter, l_opt, _, _, other in parts:
            if group:
                own = [o.replace("?", "") for o in re.sub(r"\[\w+\]", "", group).split("|")]
                choices.append(own + ([""] if g_opt else []))
            else:
                choices.append([letter or other] + ([""] if l_opt else []))
        return ["".join(p) for p in product(*choices)]

    for words in (fixed.METRICS, fixed.PERIODS, fixed.ACTIONS):
        for alternatives in words.values():
            texts = [t.lower() for a in alternatives for t in spelled(a)]
            told = spark.createDataFrame([(f"so {t} it is",) for t in texts], "t string")
            assert told.filter(~may_match(F.col("t"), alternatives)).collect() == []


def test_patterns_wait_for_their_opening_letters(spark):
    from augury.functions import guidance as g

    asked = [str(c) for c in (g.metric_mentions(F.col("s")), g.detect_period(F.col("s")), g.detect_action(F.col("s")))]
    assert all("contains" in text for text in asked)


def test_windows_of_a_folded_context_are_folded_windows(spark, texts):
    odd = "İstanbul ſays 😀 𝐀 ΑΣ İ. " * 9
    body = odd + "We expect TOTAL REVENUE for the Fiscal Year 2025, RAISED, of $5 MILLION to $6 MILLION. " + odd
    row = ops.extract_guidance(texts(body)).collect()
    assert [(r["metric"], r["val1"], r["val2"], r["pdicity"], r["fiscal_year"], r["action"]) for r in row] == [
        ("Revenue", 5e6, 6e6, "FY", 2025, "raises")
    ]


def test_staged_files_are_bounded(spark, monkeypatch):
    from checks import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 10)
    back = queries.written(spark.range(95).coalesce(1), "many")
    assert back.count() == 95 and len(back.inputFiles()) == 10


ODD_TEXTS = [
    "We expect revenue of $5 million. Sales raises² of $3 to $4 billion; cut́ and recut, raise_ it. \U0001f600 Outlook provides initial EPS of ($0.45) to ($0.50)",
    "İ expects K EPſ of $1,234.5 million. Σας targets capex of $ 3 k. Expects capex of $3 k. We see cash flow between $1 and $2 billion in Q2 2026",
    "Guides net sales of $1,23 and $2.12345. Loweredé sales of $7—8 mm, reduced. Projects gross margin of 5%. It narrows EBIT of $9! Narrows EBIT of $9! 20255 H1",
    "x " * 400 + "expects sales of $4. " + "y " * 400 + "first half. expects sales of $4. " + "We lowered it. " * 30 + "Anticipates FFO of $2\xa0b",
]


def test_records_of_texts_are_those_of_the_steps_on_rows(spark, texts):
    # G1 to G8 and D1 as column expressions, against the one pass that reads whole texts.
    df = texts(*[f"{x} {y} {x}" for x in ODD_TEXTS for y in ODD_TEXTS]).select("accession_number", "text")
    valued = ops.extract_values(ops.detect_metrics(ops.filter_guidance_sentences(ops.split_sentences(df))))
    steps = ops.truncate_sentence(ops.detect_action(ops.detect_fiscal_year(ops.detect_period(ops.dedup_in_document(valued)))))
    whole = ops.extract_guidance(df)
    columns = [c for c in whole.columns if c not in ("midpoint", "range_width")]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, steps.select(columns).collect()))
    assert whole.count() > 60


def test_texts_are_read_in_one_pass_in_python(spark, texts):
    # Records as lambdas over arrays took three times as long, and contexts went to Python and back.
    plan = ops.extract_guidance(texts(ODD_TEXTS[0]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan and "lambda" not in plan


def test_white_space_and_lower_case_are_the_same_in_python():
    from augury.functions import records
    from augury.functions.text import WHITE_CHARACTERS

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert {c for c in every if c.isspace()} == set(WHITE_CHARACTERS) == {c for c in every if records.re.match(r"\s", c)}
    assert all(len(records.fold(c)) == 1 for c in every)
    assert {c for c in every if not c.isascii() and records.fold(c).isascii()} == set("İıſK")
