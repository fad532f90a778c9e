"""Secrets behind labels of any case and spacing, and phones without a country code."""

import pytest

from lotgraph.llm import pii_surrogates

SECRET = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"


@pytest.mark.parametrize("text", [f'TOKEN = "{SECRET}"!!', f"Token={SECRET}", f"api_token: '{SECRET}'", f'"token": "{SECRET}"', f"PASSWORD={SECRET}", f'Password : "{SECRET}"', f"password='{SECRET}'"])
def test_secret_labels(text):
    assert [(k, v) for _, _, k, v in pii_surrogates.entities(text)] == [("secret", SECRET)]
    assert set(pii_surrogates.surrogate(b"k", "secret", SECRET)) <= set("0123456789ABCDEF")


@pytest.mark.parametrize("phone", ["030-5557713", "0171/5557713", "(030) 5557713", "212-555-7713", "+33 1 23 45 67 89"])
def test_phones(phone):
    assert [(k, v) for _, _, k, v in pii_surrogates.entities(f"call {phone}, or 10.0.0.1")] == [("phone", phone), ("ip", "10.0.0.1")]


def test_no_numbers_of_other_kinds():
    assert pii_surrogates.entities("on 2024-01-02 or 01-02-2024, 1 234 567 tokens = few") == []
    assert [k for _, _, k, _ in pii_surrogates.entities("0123 4567 8901 2345")] == ["card"]


def test_passwords_without_letters_are_settled(spark):
    got = pii_surrogates.replace(spark.createDataFrame([(1, "password=********")], "doc_id long, text string"), b"key").first()
    assert got.n_entities == 1 and "*" * 8 + '"' not in got.text and got.text != "password=********"
