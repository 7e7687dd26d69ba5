"""Physical plans for work that must follow one channel in time order."""
