"""brandpulse subpackage."""
