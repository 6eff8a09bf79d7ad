"""Bronze-silver-gold data marts as plain DataFrame-to-DataFrame functions."""

__version__ = "0.1.0"
