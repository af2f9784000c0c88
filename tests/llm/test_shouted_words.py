"""Shouted words count in texts of any length."""

import pytest

from tabloom.llm import toxicity


@pytest.mark.parametrize("calm", [0, 20, 2000])
def test_shouted_share_counts_words_of_every_text(calm):
    text = " ".join(["SHUT", "IT", "NOW", *["quiet"] * calm])
    values = dict(zip(toxicity.FEATURES, toxicity.features(text, toxicity.Lexicon({})), strict=True))
    assert values["shouted_share"] == 2 / (3 + calm)
