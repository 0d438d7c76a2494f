import random

import pytest

from riskloom.llm import decontaminate

ITEM = "A train leaves the station with 120 passengers and after 3 hours at 80 km it has met Maria Lopez twice while 120 people waited."


def items(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "item_id long, text string, hash string, pos int")


def found(documents, spark, docs, bench):
    return {(r.doc_id, r.item_id): r for r in decontaminate.leaks(documents(docs), items(spark, bench)).collect()}


def test_reparameterised_copies(spark, documents):
    filler = "some words before the copied part that have no meaning at all. "
    other = ITEM.replace("120", "77").replace(" 3 ", " 5 ").replace("80 km", "45 miles").replace("Maria Lopez", "Li")
    docs = [(1, filler + ITEM + " and more"), (2, filler + other), (3, filler + ITEM.replace("120 people", "99 people")), (4, filler), (5, None), (6, "")]
    out = found(documents, spark, docs, [(7, ITEM)])
    assert set(out) == {(1, 7), (2, 7)}  # in 3 one value stands for two: not a copy of this question
    assert out[1, 7].n_changed == 0 and out[2, 7].n_changed == 5 and out[1, 7].n_slots == 6  # hours are a unit, and the same in both


def test_every_planted_item_and_no_other(spark, documents, sf):
    rng = random.Random(3)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    vocabulary = [f"word{i}" for i in range(500)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs, want = [], set()
    for i in range(80):
        if i % 2:
            item, text = rng.choice(bench)
            docs.append((i, f"{prose(40)}. {text}\n{prose(30)}"))
            want.add((i, item))
        else:
            docs.append((i, prose(90)))
    assert want <= set(found(documents, spark, docs, bench)) and {d for d, _ in found(documents, spark, docs, bench)} == {d for d, _ in want}


def plain_template(text):
    """The template written word by word."""
    out, previous = [], None
    for line in text.split("\n"):
        opening = True
        for raw in line.split():
            word = raw.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
            if word:
                number = word[0].isdigit() and all(c in "0123456789.,:/%-" for c in word)
                if number:
                    kind = "number"
                elif previous == "number" and word.lower() in decontaminate.UNITS:
                    kind = "unit"
                else:
                    kind = "name" if word[0].isupper() and not opening else "word"
                if not (kind == "name" and previous == "name"):
                    out.append(kind if kind != "word" else word.lower())
                previous = kind
                opening = raw[-1] in ".!?:;\""
    return out


@pytest.mark.parametrize("text", [ITEM, "Één zin. Ñga Été Über 3 kg, 4,5 m and John Smith\nNew Line: Mr. Brown 12", "", "!!! ... 5", "A B C d"])
def test_template_against_plain(text):
    np = decontaminate.np
    data = np.frombuffer(text.encode(), np.uint8)
    token, kind, _, bounds = decontaminate.template(data, np.array([0, len(data)]))
    want = plain_template(text)
    assert len(token) == len(want) == bounds[-1]
    names = [["word", "number", "name", "unit"][k] for k in kind]
    assert [n if n != "word" else w for n, w in zip(names, want)] == want
    assert len({(w, t) for w, t in zip(want, token.tolist())}) == len(set(want))


def test_awkward_rows(spark, documents, awkward):
    bench = [(1, awkward[3][1]), (1, awkward[3][1]), (2, None), (3, ""), (None, "x y z a b c d e"), (4, "too short item"), (5, "five words are just enough")]
    out = found(documents, spark, awkward + [(50, "here five words are just enough for it")], bench)
    assert set(out) == {(4, 1), (5, 1), (6, 1), (50, 5), (9, 1)}
    assert found(documents, spark, awkward, []) == {} and found(documents, spark, [], bench) == {}
    kept = decontaminate.clean_documents(documents(awkward), items(spark, bench))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in awkward if i not in (4, 5, 6, 9))


def test_renamed_sentence_openers(spark, documents):
    item = "Tom has 3 apples. Tom buys 2 more apples. How many apples does Tom have now?"
    other = item.replace("Tom", "Anna").replace("3", "9")
    docs = [(1, f"some words first. {other}"), (2, f"some words first. {item}"), (3, other.replace("Anna buys", "Peter buys")), (4, f"they asked whether {item}")]
    out = found(documents, spark, docs, [(7, item)])
    assert set(out) == {(1, 7), (2, 7), (4, 7)}  # in 3 two names stand for one
    assert [(out[d, 7].n_windows, out[d, 7].item_windows, out[d, 7].n_changed) for d in (1, 2, 4)] == [(9, 9, 2), (9, 9, 0), (9, 9, 0)]
    # An opener in lower case and a renamed one: either template meets a part of the windows.
    mixed = "How many apples has Tom if he buys 3 apples more today. Tom gives 2 of them away and then he eats one."
    row = found(documents, spark, [(5, "tell me h" + mixed[1:].replace("Tom", "Anna"))], [(9, mixed)])[5, 9]
    assert (row.n_windows, row.item_windows, row.n_changed) == (16, 16, 1)
    # A name after the end of a sentence is not one with the name before it, and one of several words is one name.
    two = "Yesterday evening they all met Maria Lopez. Tom Miller has 3 large boxes with 5 red apples and gives 2 away."
    assert set(found(documents, spark, [(6, two.replace("Tom Miller", "Li").replace("Maria Lopez", "Jan"))], [(8, two)])) == {(6, 8)}


def test_items_of_numbers_and_names_are_searched_for(spark, documents):
    sums, title, year = "Compute 12 + 45 - 7 * 3 / 9", "Beren Met Luthien Near Doriath", "In 1999, 2001, 2003, 2005, 2007 and 2011"
    docs = [(1, f"a sheet of sums: please {sums} and so on"), (2, sums.replace("45", "46")), (3, f"as told, {title}."), (4, "Beren Met Luthien Near Gondolin"), (5, f"seen.\n{year}"), (6, "x")]
    out = found(documents, spark, docs, [(1, sums), (2, title), (3, year), (4, "12 34 56 78"), (5, "1 2 3 4 5")])
    assert set(out) == {(1, 1), (3, 2), (5, 3)}
    assert all(r.coverage == 1.0 and r.n_changed == 0 for r in out.values())
    # Literal windows do not hide a copy with other values: that is judged by the share of template windows.
    long = f"the first list of numbers to be added up is {' '.join(str(i) for i in range(100, 130))}"
    other = long.replace(" 1", " 2")
    row = found(documents, spark, [(1, long), (2, other)], [(7, long)])
    assert set(row) == {(1, 7), (2, 7)} and row[1, 7].n_windows > row[2, 7].n_windows


def test_items_in_capitals(spark, documents):
    item = "The old bridge near the river was built by Tom Miller in 1890 and it carried 40 carts on every market day."
    docs = [(1, f"first some words.\n{item.upper()}\nand an end"), (2, f"it was SAID that {item}"), (3, "THE OLD BRIDGE\nNEAR THE SEA")]
    assert set(found(documents, spark, docs, [(7, item)])) == {(1, 7), (2, 7)}
    assert set(found(documents, spark, [(1, item)], [(7, item.upper())])) == {(1, 7)}


def test_copies_with_a_phrase_left_out(spark, documents):
    words = "each morning at dawn several quiet fishers carry their long nets past that old stone tower and down toward a cold harbour".split()
    assert len(words) == 22
    cut, half = " ".join(words[:8] + words[11:]), " ".join(words[:12])
    row = found(documents, spark, [(1, f"so {cut} again"), (2, half), (3, " ".join(words[11:] + words[:11]))], [(7, " ".join(words))])
    assert set(row) == {(1, 7), (3, 7)}
    assert (row[1, 7].n_windows, row[1, 7].item_windows, round(row[1, 7].word_coverage, 3)) == (5, 15, round(19 / 22, 3))


def test_items_of_few_words(spark, documents):
    docs = [(1, "He asked. Why not? And left."), (2, "he asked why not and left"), (3, "a\nWHY NOT\nb"), (4, "why not"), (5, "Why not go"), (6, "first. Four short words here\nend"), (7, "more than four short words here")]
    assert set(found(documents, spark, docs, [(1, "Why not?"), (2, "four short words here"), (3, "!?")])) == {(1, 1), (3, 1), (4, 1), (6, 2)}


def test_a_long_text_that_repeats_one_item(spark, documents):
    row = found(documents, spark, [(1, "\n".join([ITEM] * 4000))], [(7, ITEM)])
    assert set(row) == {(1, 7)} and row[1, 7].n_windows == row[1, 7].item_windows and row[1, 7].n_changed == 0


def plain_leaks(docs, bench):
    """Templates written word by word, windows of 8 tokens, values by alignment; items of words enough and no more forms than the plain one."""
    size, found = decontaminate.SIZE, set()
    for doc_id, text in docs:
        tokens, values = plain_tokens(text)
        for item_id, item in bench:
            item_tokens, item_values = plain_tokens(item)
            starts = range(len(item_tokens) - size + 1)
            good = [s for s in starts if 2 * sum(t not in ("<number>", "<name>", "<unit>") for t in item_tokens[s : s + size]) >= size]
            matched = {}
            for s in good:
                for d in range(len(tokens) - size + 1):
                    if tokens[d : d + size] == item_tokens[s : s + size]:
                        matched.setdefault(d - s, []).append(s)
            kept = set()
            for shift, at in matched.items():
                slots = {}
                for s in at:
                    for k in range(s, s + size):
                        if item_values[k]:
                            slots.setdefault(item_values[k], set()).add(values[k + shift])
                if all(len(v) == 1 for v in slots.values()):
                    kept.update(at)
            if good and len(kept) >= decontaminate.COVERAGE * len(good):
                found.add((doc_id, item_id))
    return found


def plain_tokens(text):
    """Template and the values in its placeholders, for lines that hold small letters and names inside sentences."""
    tokens, values, opening = [], [], True
    for raw in text.split():
        word = raw.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        if word[0].isdigit():
            kind = "<number>"
        elif tokens and tokens[-1] == "<number>" and word.lower() in decontaminate.UNITS:
            kind = "<unit>"
        else:
            kind = "<name>" if word[0].isupper() and not opening else word.lower()
        if kind == "<name>" and tokens and tokens[-1] == "<name>":
            values[-1] += " " + word.lower()
        else:
            tokens.append(kind)
            values.append(word.lower() if kind.startswith("<") else "")
        opening = raw[-1] in ".!?:;"
    return tokens, values


def test_against_plain_windows_and_slots(spark, documents):
    rng = random.Random(11)
    common = ["the", "of", "with", "boxes", "rows", "holds", "more", "than", "each", "buyer", "pays", "after"]

    def sentence(n):
        pick = lambda: rng.choice(["number", "name"] + ["word"] * 5)
        parts = [{"number": str(rng.randint(1, 30)), "name": rng.choice(["Ann", "Bob", "Cy"]), "word": rng.choice(common)}[pick()] for _ in range(n)]
        return " ".join(["it"] + parts) + "."

    bench = [(i, sentence(24)) for i in range(25)]
    docs = []
    for i in range(150):
        _, item = rng.choice(bench)
        parts = item.split()
        for _ in range(rng.randint(0, 4)):  # change words, and values so that some clash
            k = rng.randrange(1, len(parts) - 1)
            if parts[k].isdigit() and rng.random() < 0.7:
                parts = [("77" if p == parts[k] else p) for p in parts] if rng.random() < 0.5 else parts[:k] + ["99"] + parts[k + 1 :]
            else:
                parts[k] = rng.choice(common)
        docs.append((i, f"{sentence(10)} {' '.join(parts)} {sentence(6)}"))
    out = found(documents, spark, docs, bench)
    want = plain_leaks(docs, bench)
    assert want and want <= set(out)
    # What more is found is found by the second template, by literal windows or by the share of words.
    assert all(r.coverage >= decontaminate.COVERAGE or r.word_coverage >= decontaminate.WORD_COVERAGE for r in out.values())
    assert len(set(out) - want) < len(want)
