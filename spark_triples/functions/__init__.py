from spark_triples.functions.terms import *  # noqa: F401,F403
