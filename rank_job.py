"""Script for spark-submit: see ``quillrank.plans.job``."""

from quillrank.plans.job import main

if __name__ == "__main__":
    main()
