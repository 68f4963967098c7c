"""Operations of a training-data pipeline: media, tokens, mixing, near and exact duplicates, secrets, personal data,
quality, URLs and languages.

Nothing outside this subpackage imports it.
"""
