"""DataFrame operators; each builds a plan and runs nothing by itself unless said."""
