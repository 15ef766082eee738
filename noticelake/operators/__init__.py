"""DataFrame -> DataFrame operators; each works in ``DataFrame.transform``."""
