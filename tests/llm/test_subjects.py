import random

from millrace.llm.subjects import assign_subjects, bags, sentences

TERMS = {
    "law": ["判決文", "原告", "弁護士", "遺言書", "控訴審", "仲裁", "条例", "登記"],
    "food": ["味噌", "出汁", "豆腐", "串焼き", "蕎麦", "漬物", "昆布", "献立"],
    "sport": ["監督", "駅伝", "捕手", "審判", "決勝戦", "主将", "体操", "打率"],
}
NEUTRAL = ["この日、町の空はよく晴れていた。", "写真は昔のものです。", "続きは掲示で読めます。", "思い出は尽きない。"]


def text(r, subject, n, other=None, m=0, neutral=0):
    own = [f"{r.choice(TERMS[subject])}と{r.choice(TERMS[subject])}の話が続いた。" for _ in range(n)]
    own += [f"{r.choice(TERMS[other])}も{r.choice(TERMS[other])}も同じことだった。" for _ in range(m)]
    own += [r.choice(NEUTRAL) for _ in range(neutral)]
    r.shuffle(own)
    return "".join(own)


def test_held_out_accuracy(spark):
    r = random.Random(2)
    names = list(TERMS)
    rows, truth = [], {}
    for i in range(600):
        a, b = r.sample(names, 2)
        two = i % 3 == 0
        rows.append((i, text(r, a, 5, b, 4 if two else 1, 2), "x"))
        truth[i] = {a, b} if two else {a}
    rows += [(None, "判決文", ""), (900, None, ""), (901, "", ""), (902, "  \n", ""), (903, "".join(NEUTRAL), "")]
    # The examples show half of each subject's terms.
    examples = [(s, "".join(f"{t}の話が続いた。" for t in TERMS[s][:4])) for s in names]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, subject string").repartition(4)
    given = spark.createDataFrame(examples, "subject string, body string")
    got = {}
    for row in assign_subjects(docs, given).collect():
        got.setdefault(row.doc_id, set()).add(row.subject)
    right = sum(got.get(i, set()) == want for i, want in truth.items())
    assert right > 0.9 * len(truth)
    assert not set(got) & {900, 901, 902}
    assert assign_subjects(docs.limit(0), given).count() == 0
    assert assign_subjects(docs, given.limit(0)).count() == 0


def test_sentences_and_bags(spark):
    assert sentences("「配当。」と言った。次！\nEnd here. And there") == ["「配当。」と言った", "次", "end here", "and there"]
    df = spark.createDataFrame([(1, "判決文。味噌と出汁。"), (2, None), (3, "。。")], "doc_id bigint, text string")
    got = {r.row_id: r for r in bags(df, "doc_id", "text").collect()}
    assert got[1].n_sentences == 2 and got[1].places == [0, 1, 1] and got[2].n_sentences == 0 and got[3].n_sentences == 0


RUSSIAN = {"law": ["приговор", "истец", "адвокат", "завещание"], "food": ["бульон", "соус", "лапша", "рецепт"], "sport": ["матч", "тренер", "судья"]}
KOREAN = {"law": ["판결문을", "변호사가", "유언장은"], "food": ["된장국을", "두부는", "국수가"], "sport": ["감독이", "선수는", "결승전을"]}
KANA = {"law": ["さいばん", "べんごし", "ゆいごん"], "food": ["みそしる", "とうふ", "うどん"], "sport": ["しあい", "かんとく", "せんしゅ"]}


def test_other_scripts(spark):
    r = random.Random(4)
    rows, truth, examples = [], {}, []
    for words, sentence in ((RUSSIAN, "Вчера был {} и ещё {}."), (KOREAN, "어제 {} {} 보았다."), (KANA, "きのう {} と {} だった。")):
        examples += [(s, " ".join(sentence.format(t, t) for t in words[s])) for s in words]
        for _ in range(60):
            i, s = len(rows), r.choice(list(words))
            rows.append((i, " ".join(sentence.format(r.choice(words[s]), r.choice(words[s])) for _ in range(4))))
            truth[i] = s
    got = {}
    for row in assign_subjects(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(examples, "subject string, body string")).collect():
        got.setdefault(row.doc_id, set()).add(row.subject)
    assert sum(got.get(i) == {s} for i, s in truth.items()) > 0.9 * len(truth)


def test_a_small_subject_is_found_among_many_documents(spark):
    r = random.Random(6)
    rows = [(i, text(r, r.choice(["law", "food"]), 4)) for i in range(6000)] + [(10_000 + i, text(r, "sport", 4)) for i in range(6)]
    examples = [(s, "".join(f"{t}の話が続いた。" for t in TERMS[s])) for s in TERMS]
    got = assign_subjects(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), spark.createDataFrame(examples, "subject string, body string"))
    assert {r.doc_id for r in got.filter("subject = 'sport'").collect()} == {10_000 + i for i in range(6)}
