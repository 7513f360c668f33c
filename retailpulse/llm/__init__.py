"""Operators of a training-data pipeline; nothing outside this folder imports it."""

from retailpulse.session import send_with_task

# Tasks carry the functions they call: executors need the libraries, not this package.
send_with_task(__name__)
