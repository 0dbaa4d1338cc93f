"""op10: held-out accuracy on the given table, spans of mixed text, scripts, edge cases."""

import random

from pyspark.sql import functions as F

from weekcast.llm import common, lang_id, queries

from given import SF_CHECK

EN = "the house and the garden with the old tree that stands by the river "
DE = "das haus und der garten mit dem alten baum der an dem fluss steht "
RU = "дом и сад со старым деревом которое стоит у реки "


def test_held_out_accuracy(spark):
    truth = common.table(spark, SF_CHECK, "documents").select("doc_id", "lang")
    found = queries.op10_language(spark, SF_CHECK).join(truth, "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def model(spark):
    rows = [(i, t * 5, lang) for i, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru")] * 8)]
    return lang_id.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))


def test_spans_of_mixed_text(spark):
    m = model(spark)
    spans = m.spans([EN + DE + RU, "", "12 34"])
    assert [s[0] for s in spans[0]] == ["en", "de", "ru"]
    assert abs(spans[0][1][1] - len(EN.split())) <= 1 and spans[1:] == [[], []]
    assert sum(s[2] for s in spans[0]) == len((EN + DE + RU).split())


def brute_force(m, w):
    """Viterbi of one text in plain Python."""
    s = m.word_scores(w)
    value, back = list(s[0]), []
    for row in s[1:]:
        lead = max(range(len(value)), key=lambda k: value[k])
        step = [(value[k], k) if value[k] >= value[lead] - m.switch else (value[lead] - m.switch, lead) for k in range(len(value))]
        back.append([k for _, k in step])
        value = [v + float(x) for (v, _), x in zip(step, row)]
    at = max(range(len(value)), key=lambda k: value[k])
    out = [at]
    for b in reversed(back):
        out.append(b[out[-1]])
    return out[::-1]


def test_viterbi_of_many_texts_equals_one_by_one(spark):
    m = model(spark)
    texts = [EN, DE + EN, "", RU + EN + DE + RU, "haus the", "и"]
    w = lang_id.words_of(texts, m.classes)
    got = m.label(w, len(texts)).tolist()
    want = [x for t in texts if t for x in brute_force(m, lang_id.words_of([t], m.classes))]
    assert got == want


def test_script_leaves_one_candidate(spark):
    m = model(spark)
    assert m.predict(["жжжж щщщ"])[0] == ["ru"]


def test_edge_cases(spark, docs):
    rows = [(1, EN), (1, EN), (2, None), (3, ""), (4, "12 !? ..."), (None, EN), (5, EN * 3000), (6, "x")]
    out = lang_id.identify(docs(rows))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == len(rows)
    assert {r.doc_id for r in out.where("lang_pred = 'und' and score = 0").collect()} == {2, 3, 4}
    assert lang_id.identify(docs([])).count() == 0
    nolabel = docs(rows).withColumn("lang", F.lit(None).cast("string"))
    assert lang_id.identify(nolabel).where("lang_pred = 'und'").count() == len(rows)
    kept = lang_id.keep_identified(docs(rows), 0.4)
    assert kept.columns == docs(rows).columns and kept.count() == 5


def test_two_hundred_languages(spark):
    """Labels of any number of languages: every text in its own."""
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{i:03d}": ["".join(rnd.choice(letters) for _ in range(6)) for _ in range(12)] for i in range(200)}
    rows = [(i * 1000 + k, " ".join(rnd.choice(own) for _ in range(30)), lang) for i, (lang, own) in enumerate(words.items()) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = lang_id.identify(df).collect()
    want = {i: lang for i, _, lang in rows}
    assert sum(r.lang_pred == want[r.doc_id] for r in out) > 0.97 * len(rows)
