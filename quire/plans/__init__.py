"""Named queries (one per operator of the survey) and their SQL oracles."""


def load_all() -> None:
    """Import every query module so that its queries register themselves."""
    from quire.plans import q_chunks, q_digest, q_extract, q_infer, q_mail, q_select  # noqa: F401
