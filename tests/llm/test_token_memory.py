"""What an encoder keeps of the words it has met."""

from delaylab.llm import packing, tokens


def test_an_encoder_remembers_little_and_encodes_alike():
    encoder = tokens.ByteBpe(packing.public_vocabulary())
    most = 0
    for chunk in range(14):
        encoder.encode([" ".join(f"{i:x}q" for i in range(chunk * 50_000, (chunk + 1) * 50_000))])
        most = max(most, sum(a.nbytes for a in (encoder._keys, encoder._number)))
    assert most < 40_000_000
    ids, _ = encoder.encode(["3q a7q it's  3q"])
    fresh, _ = tokens.ByteBpe(packing.public_vocabulary()).encode(["3q a7q it's  3q"])
    assert ids.tolist() == fresh.tolist()
