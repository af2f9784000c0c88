"""Entry script for spark-submit; see tabloom/jobs.py."""

from tabloom.jobs import main

main()
