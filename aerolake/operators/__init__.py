"""DataFrame -> DataFrame operators of the Silver and Gold layers."""
