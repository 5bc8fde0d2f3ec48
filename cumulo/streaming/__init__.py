"""Structured Streaming jobs (inventory section 2L): pure transforms in
`windows`, sources / sinks / checkpoints in `runner`."""
