from tallyhouse.cli import run

run()
