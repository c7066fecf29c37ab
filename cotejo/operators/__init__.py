"""DataFrame -> DataFrame operators. None of them runs a job; all of them are lazy."""
