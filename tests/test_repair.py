import pytest

from salesmart.functions.text import repair_decoding


def broken(text: str, times: int = 1) -> str:
    for _ in range(times):
        text = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in text.encode("utf-8"))
    return text


def repaired(spark, values, **more):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r[0] for r in df.orderBy("n").select(repair_decoding("v", **more)).collect()]


def test_every_code_point_comes_back(spark):
    points = [chr(p) for p in [*range(0x80, 0x3000), *range(0xFF00, 0x10000, 7), *range(0x1F300, 0x1F700, 5)]]
    assert repaired(spark, [broken(f"x{p}y") for p in points]) == [f"x{p}y" for p in points]


@pytest.mark.parametrize("times", [1, 2, 3])
def test_broken_several_times(spark, times):
    texts = ["Winston–Salem", "Kraków", "naïve “quotes”", "東京", "ÄÖÜ ß €"]
    assert repaired(spark, [broken(t, times) for t in texts]) == texts


def test_clean_values_never_change(spark):
    clean = [None, "", "plain", "café", "São Paulo", "Ünïcödé", "5 °C", "東京", "a – b", "“x”", "Á", "é€", "İstanbul", "\x85", "😀 ok", "Ã", "naïve – café"]
    assert repaired(spark, clean) == clean


def test_documents_never_change(spark):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    assert repaired(spark, texts) == texts


def test_partly_broken_values_stay(spark):
    assert repaired(spark, ["é and Ã©"]) == ["é and Ã©"]
