"""``python -m zonehour <subcommand> ...``: the same entry point as plans/cli.py."""

from zonehour.plans.cli import run

run()
