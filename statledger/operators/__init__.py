"""DataFrame -> DataFrame operators; every one composes with ``DataFrame.transform``."""
