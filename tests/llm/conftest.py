import pytest

SMOKE, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

ODD_TEXTS = [
    None, "", " \n\t ", "word", "a b c", "A b C", "one two three four five six seven eight",
    "ONE two\nthree four five six  seven eight", "one two three four five six seven eight nine",
    "çà et là, où l'été s'en va", "日本語のテキスト と 漢字 İstanbul ΣΑΣ é", "a <|endoftext|> b<|startoftext|>c",
    "12345 !!! ??? ###", "\x1c\x1d x\x85y\xa0z", "  two  spaces   three \n end ", "mail bob.42@mail8.example.com, call +1 (988) 555-2485",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, odd, long and repeated rows, with columns whose names clash with the operators' own."""
    long = " ".join(f"w{i % 977} x{i % 1013}" for i in range(60_000))
    texts = [*ODD_TEXTS, long, long + " more", "one " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, " \n\t "), (3, "word"), (3, "another text under the same id here"), (None, "no id at all"), (None, None)]
    clash = [(i, t, "en" if t and k % 2 else None, f"s{k}", len(t or ""), 0.5, "x", True, k, k, "k", [1], b"i") for k, (i, t) in enumerate(rows)]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, Accepted boolean, "
        "n int, part int, key string, tokens array<int>, ids binary"
    )
    return spark.createDataFrame(clash, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
