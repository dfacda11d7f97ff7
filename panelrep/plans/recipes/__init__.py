"""One module per indicator family; every recipe is lazy and takes its bridges as arguments."""
